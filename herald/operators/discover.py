"""Discovery of new campaigns among Unknown templates.

The gates (coverage, minimum unknown count) are a per-sender aggregate joined
back as a semi join, so gated senders drop out of the plan instead of being
tested on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald import config
from herald.operators.assign import is_known
from herald.operators.centroids import centroids
from herald.operators.profile import member_similarity, nearest_examples
from herald.session import cut_lineage


# A7 + A8
def coverage_by_originator(assigned: DataFrame, key: str = "originator_id") -> DataFrame:
    """Known share and Unknown count per sender (all rows Unknown without a status)."""
    known = is_known() if "status" in assigned.columns else F.lit(False)
    return assigned.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.avg(known.cast("double")), F.lit(0.0)).alias("coverage"),
        F.count_if(~known).alias("n_unknown"))


# F12 + F13
def eligible_originators(assigned: DataFrame, min_coverage: float = config.MIN_COVERAGE,
                         min_unassigned: int = config.MIN_UNASSIGNED,
                         key: str = "originator_id") -> DataFrame:
    c = coverage_by_originator(assigned, key)
    return c.filter((F.col("coverage") < min_coverage) & (F.col("n_unknown") >= min_unassigned))


def unknown_for_discovery(assigned: DataFrame, min_coverage: float = config.MIN_COVERAGE,
                          min_unassigned: int = config.MIN_UNASSIGNED,
                          key: str = "originator_id") -> DataFrame:
    """Unknown templates of the senders that pass both gates."""
    ok = eligible_originators(assigned, min_coverage, min_unassigned, key).select(key)
    return assigned.filter(~is_known()).join(ok, key, "left_semi")


# F18
def adaptive_parameters(templates: DataFrame, key: str = "originator_id",
                        frac: float = config.MIN_CLUSTER_FRAC, size_floor: int = config.MIN_CLUSTER_SIZE_FLOOR,
                        samples_floor: int = config.MIN_SAMPLES_FLOOR,
                        min_samples: int | None = None) -> DataFrame:
    """Per sender of ``n`` templates: ``min_cluster_size = max(floor, int(frac * n))`` and
    ``min_samples``, the given one or else ``max(floor, int(sqrt(n)))``."""
    n = F.count(F.lit(1))
    samples = F.lit(min_samples) if min_samples is not None else \
        F.greatest(F.lit(samples_floor), F.floor(F.sqrt(n)).cast("int"))
    return templates.groupBy(key).agg(
        F.greatest(F.lit(size_floor), F.floor(n * F.lit(frac)).cast("int")).alias("min_cluster_size"),
        F.max(samples).alias("min_samples") if min_samples is not None else samples.alias("min_samples"))


def propose_clusters(labelled: DataFrame, namer=None, key: str = "originator_id",
                     label_col: str = "cluster_label", vec_col: str = "embedding",
                     min_members: int = config.MIN_CLUSTER_MEMBERS,
                     n_samples: int = config.N_SAMPLES, max_words: int = config.MAX_WORDS):
    """The kept clusters and their members.

    Returns ``(clusters, members)``: clusters carry label, size, centroid and
    proposed name; members, one row each, carry ``sim_score`` and their ``rank`` by
    similarity within the cluster's samples (null beyond ``n_samples``).
    """
    from herald.operators.naming import name_from_samples

    valid = labelled.filter(F.col(label_col) != -1)
    keys = [key, label_col]
    sizes = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("cluster_size"))
    kept = sizes.filter(F.col("cluster_size") >= min_members)                      # F11
    members = valid.join(kept.select(*keys), keys, "left_semi")
    cents = cut_lineage(centroids(members, keys, vec_col).withColumn("row_index", F.lit(0)))
    members = cut_lineage(member_similarity(members, cents, key, label_col, vec_col).drop("row_index"))
    top = nearest_examples(members, n_samples, key, label_col)                      # W2
    text = "normalized_text" if "normalized_text" in top.columns else None
    top = top.withColumn("text_sample", F.col(text) if text else F.lit(""))
    names = (namer or (lambda e: name_from_samples(e, keys, max_words=max_words,
                                                   out="proposed_label")))(top)
    clusters = (kept.join(cents.drop("row_index"), keys).join(names, keys, "left")
                    .withColumn("proposed_label", F.coalesce("proposed_label", F.lit(""))))
    ranks = top.select(key, "template_hash", "rank")
    return cut_lineage(clusters), members.join(ranks, [key, "template_hash"], "left")


# J8 + F14
def upsert_proposals(assigned: DataFrame, clusters: DataFrame, members: DataFrame,
                     key: str = "originator_id", label_col: str = "cluster_label",
                     threshold: float = config.CENTROID_SIM_THRESHOLD) -> DataFrame:
    """Write cluster id / score to member rows; the name only when sim >= threshold."""
    m = members.select(key, "template_hash", F.col(label_col).alias("proposed_cluster_id"),
                       F.col("sim_score").alias("proposed_campaign_score")) \
               .join(clusters.select(key, F.col(label_col).alias("proposed_cluster_id"),
                                     "proposed_label"), [key, "proposed_cluster_id"])
    out = assigned.join(m, [key, "template_hash"], "left")
    name = F.when(F.col("proposed_cluster_id").isNull(), F.lit(None).cast("string")) \
            .when(F.col("proposed_campaign_score") >= threshold, F.col("proposed_label")) \
            .otherwise(F.lit(""))
    return out.withColumn("proposed_campaign_name", name).drop("proposed_label") \
              .withColumn("proposed_cluster_id", F.col("proposed_cluster_id").cast("int"))


# V11 + W4 + A6
def new_campaigns(clusters: DataFrame, members: DataFrame, key: str = "originator_id",
                  label_col: str = "cluster_label", time_col: str | None = None,
                  run_ts=None) -> DataFrame:
    """Campaign-style rows for the proposals; dates from ``time_col`` else ``run_ts``."""
    w = Window.partitionBy(key).orderBy(label_col)
    base = clusters.select(key, label_col, "cluster_size", "proposed_label")
    now = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    if time_col and time_col in members.columns:
        rng = members.groupBy(key, label_col).agg(
            F.min(F.try_to_timestamp(F.col(time_col).cast("string"))).alias("s"),
            F.max(F.try_to_timestamp(F.col(time_col).cast("string"))).alias("e"))
        base = base.join(rng, [key, label_col], "left")
    else:
        base = base.withColumn("s", F.lit(None).cast("timestamp")).withColumn("e", F.lit(None).cast("timestamp"))
    return base.select(
        key, (F.row_number().over(w) - 1).cast("int").alias("row_index"),
        F.col(label_col).cast("int").alias("cluster_label"),
        F.col("cluster_size").cast("long").alias("proto_count"),
        F.col("cluster_size").cast("long").alias("msg_count"),
        F.coalesce("s", now).alias("date_range_start"), F.coalesce("e", now).alias("date_range_end"),
        F.col("proposed_label").alias("campaign_name"), F.lit("Unknown").alias("status"))


# V10
def unknown_labels(proposals: DataFrame) -> DataFrame:
    """Unknown rows with their proposed cluster, -1 when none."""
    return proposals.filter(~is_known()).withColumn(
        "unknown_label", F.coalesce(F.col("proposed_cluster_id"), F.lit(-1)))


def discover(assigned: DataFrame, cluster_fn, namer=None, key: str = "originator_id",
             vec_col: str = "embedding", min_coverage: float = config.MIN_COVERAGE,
             min_unassigned: int = config.MIN_UNASSIGNED,
             min_members: int = config.MIN_CLUSTER_MEMBERS, n_samples: int = config.N_SAMPLES,
             max_words: int = config.MAX_WORDS,
             threshold: float = config.CENTROID_SIM_THRESHOLD, run_ts=None):
    """V8: gates -> ``cluster_fn(unknown) -> + cluster_label`` -> proposals -> upsert.

    Returns ``(upserted, clusters, new_campaign_rows)``.
    """
    unknown = unknown_for_discovery(assigned, min_coverage, min_unassigned, key)
    labelled = cut_lineage(cluster_fn(unknown))
    clusters, members = propose_clusters(labelled, namer, key, "cluster_label", vec_col,
                                         min_members, n_samples, max_words)
    upserted = upsert_proposals(assigned, clusters, members, key, "cluster_label", threshold)
    ts = "timestamp" if "timestamp" in assigned.columns else ("date" if "date" in assigned.columns else None)
    nc = new_campaigns(clusters, members, key, "cluster_label", ts, run_ts)
    return upserted, clusters, nc
