"""Reference profile (V7) from clustered templates: campaigns, examples, names.

Input: templates with ``originator_id, template_hash, cluster_label`` (-1 =
noise), a vector column and optionally ``count_in_window``, ``message_id``,
``normalized_text`` and a time column. All senders are profiled in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald import config
from herald.operators.blocks import nearest_center
from herald.operators.centroids import centroids, cluster_counts
from herald.session import cut_lineage


# F10 + W3
def campaign_table(clustered: DataFrame, key: str = "originator_id",
                   label_col: str = "cluster_label", vec_col: str = "embedding",
                   weighted: bool = True) -> DataFrame:
    """One row per non-noise cluster: counts, date range, centroid, ``row_index``."""
    valid = clustered.filter(F.col(label_col) != -1)
    keys = [key, label_col]
    camps = centroids(valid, keys, vec_col).join(cluster_counts(valid, keys, weighted=weighted), keys)
    w = Window.partitionBy(key).orderBy(label_col)
    return camps.withColumn("row_index", (F.row_number().over(w) - 1).cast("int")) \
                .withColumn(label_col, F.col(label_col).cast("int"))


def member_similarity(clustered: DataFrame, camps: DataFrame, key: str = "originator_id",
                      label_col: str = "cluster_label", vec_col: str = "embedding",
                      id_col: str = "template_hash") -> DataFrame:
    """Each member with ``sim_score`` = cosine to its cluster's centroid (V3), in blocks of a cluster."""
    own = [key, label_col]
    sims = nearest_center(clustered, camps, own, id_col, vec_col).withColumnRenamed("score", "sim_score")
    return clustered.join(sims, [*own, id_col])


# W1 / W2
def nearest_examples(members: DataFrame, n: int = config.N_NEAREST, key: str = "originator_id",
                     label_col: str = "cluster_label") -> DataFrame:
    """Top ``n`` members per cluster by similarity (ties: template hash), rank from 1.

    ``row_number() <= n`` lets Spark insert a partial per-group limit before the
    shuffle, so a huge cluster ships at most ``n`` rows per map task.
    """
    w = Window.partitionBy(key, label_col).orderBy(F.desc("sim_score"), "template_hash")
    return members.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def build_profile(clustered: DataFrame, namer=None, n_nearest: int = config.N_NEAREST,
                  key: str = "originator_id", label_col: str = "cluster_label",
                  vec_col: str = "embedding", weighted: bool = True,
                  max_words: int = config.MAX_WORDS):
    """V7: ``(campaigns, examples)``.

    ``namer(examples_df) -> (key, label_col, campaign_name)``; default is the
    TF-IDF term scorer of :mod:`herald.operators.naming`.
    """
    from herald.operators.naming import name_from_samples

    # written once each: campaigns, examples and names are all read several times
    camps = cut_lineage(campaign_table(clustered, key, label_col, vec_col, weighted))
    members = member_similarity(clustered, camps, key, label_col, vec_col)
    text = "normalized_text" if "normalized_text" in members.columns else None
    ex = nearest_examples(members, n_nearest, key, label_col)
    ex = cut_lineage(ex.select(
        key, F.col("row_index").alias("campaign_row_index"), label_col, F.col("rank").cast("int"),
        (F.col("message_id") if "message_id" in ex.columns else F.lit("")).alias("message_id"),
        "template_hash",
        (F.col(text) if text else F.lit("")).alias("text_sample"),
        "sim_score",
        (F.col("count_in_window").cast("long") if "count_in_window" in ex.columns
         else F.lit(1).cast("long")).alias("count_in_window")))
    names = cut_lineage((namer or (lambda e: name_from_samples(e, [key, label_col], max_words=max_words)))(ex))
    camps = camps.join(names, [key, label_col], "left") \
                 .withColumn("campaign_name", F.coalesce("campaign_name", F.lit("")))
    ex = ex.join(camps.select(key, label_col, "campaign_name"), [key, label_col], "left")
    return camps, ex
