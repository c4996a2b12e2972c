"""Connected components of links between items, as rounds of joins.

A round gives every item the smallest label among itself and its neighbours,
then follows the label's own label (pointer jumping), so the number of rounds
grows with the logarithm of a component's diameter. Rounds are written to the
shared scratch folder and superseded ones removed; the loop ends when no label
changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import Scratch


def component_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(item, label): every item of ``links`` with the smallest item it can reach.

    Links are undirected; repeated links and links of an item with itself are
    harmless; links with a null end are dropped. Items without links have no row.
    """
    spark = links.sparkSession
    scratch = Scratch(spark, "components")
    both = F.array(F.struct(F.col(a).alias("item"), F.col(b).alias("other")),
                   F.struct(F.col(b).alias("item"), F.col(a).alias("other")))
    edges = scratch.few(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
                        .select(F.explode(both).alias("e")).select("e.*").distinct())
    labels = scratch.few(edges.groupBy("item").agg(F.min("other").alias("low"))
                         .select("item", F.col("item").alias("was"), F.least("item", "low").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("item").alias("other"), "label"), "other") \
            .groupBy("item").agg(F.min("label").alias("near"))
        low = labels.join(near, "item").select("item", "label", F.least("label", "near").alias("low"))
        roots = labels.select(F.col("item").alias("low"), F.col("label").alias("root"))
        step = scratch.few(low.join(roots, "low", "left").select(
            "item", F.col("label").alias("was"), F.least("low", "root").alias("label")))
        changed = step.filter("label < was").limit(1).count()
        scratch.drop(labels)
        if not changed:
            return step.select("item", "label")
        labels = step
