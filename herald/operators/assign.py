"""Nearest-campaign assignment.

Templates and the campaigns of their sender meet in blocks
(:mod:`herald.operators.blocks`): one matrix product a block, no campaign array on
any template row, and no broadcast. Names and labels are joined afterwards by
the campaign's row index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald import config
from herald.operators.blocks import nearest_center


# V4 = J2 + J3 + F8
def assign_to_campaigns(templates: DataFrame, campaigns: DataFrame,
                        sim_threshold: float = config.SIM_THRESHOLD,
                        key: str = "originator_id", vec_col: str = "embedding",
                        id_col: str = "template_hash", nearest=nearest_center) -> DataFrame:
    """Nearest centroid per template; ties go to the lowest ``row_index``.

    ``nearest`` is the search: plain blocks, or :func:`herald.operators.pruned.nearest_center_pruned`
    for senders with very many campaigns. ``id_col`` must be unique within a sender. Senders without campaigns get null
    assignment and status ``Unknown``.
    """
    best = nearest(templates, campaigns, [key], id_col, vec_col) \
        .withColumnsRenamed({"row_index": "assigned_campaign_row_index", "score": "assigned_campaign_score"})
    name = F.col("campaign_name") if "campaign_name" in campaigns.columns else F.lit("")
    named = campaigns.select(key, F.col("row_index").cast("int").alias("assigned_campaign_row_index"),
                             F.col("cluster_label").cast("int").alias("assigned_campaign_label"),
                             name.cast("string").alias("assigned_campaign_name"))
    found = best.join(named, [key, "assigned_campaign_row_index"])
    return templates.join(found, [key, id_col], "left").select(
        *[templates[c] for c in templates.columns], "assigned_campaign_row_index", "assigned_campaign_score",
        "assigned_campaign_label",
        F.coalesce("assigned_campaign_name", F.lit("")).alias("assigned_campaign_name"),
        F.when(F.col("assigned_campaign_score") >= F.lit(sim_threshold), "Known").otherwise("Unknown")
         .alias("status"))


# F9
def is_known(col: str = "status"):
    return F.lower(F.col(col).cast("string")) == F.lit("known")


# V14
def assigned_label_or_noise(assigned: DataFrame, max_distance: float) -> DataFrame:
    """Cluster label of the nearest centroid, -1 when 1 - cosine exceeds the limit."""
    return assigned.withColumn(
        "plot_label",
        F.when((F.lit(1.0) - F.col("assigned_campaign_score")) > F.lit(max_distance), F.lit(-1))
         .otherwise(F.coalesce(F.col("assigned_campaign_label"), F.lit(-1))))
