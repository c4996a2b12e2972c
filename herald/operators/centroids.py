"""Per-cluster aggregates (A3, A4, A5).

The centroid is Spark ML's vector mean of the normalised members: one vector
buffer per cluster and task, merged map-side, so a huge cluster costs one row
per task.
"""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.functions.vectors import unit_normalize


# A3
def centroids(df: DataFrame, keys, vec_col: str = "embedding",
              out: str = "centroid") -> DataFrame:
    """Unit-length mean of the (unit-normalised) member vectors per ``keys``."""
    keys = list(keys)
    vectors = df.select(*keys, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    unit = Normalizer(inputCol="__v", outputCol="__u", p=2.0).transform(vectors)
    mean = unit.groupBy(*keys).agg(vector_to_array(Summarizer.mean(F.col("__u"))).alias("__m"))
    return mean.select(*keys, unit_normalize("__m").alias(out))


# A4 + A5
def cluster_counts(df: DataFrame, keys, weight_col: str | None = "count_in_window",
                   weighted: bool = True) -> DataFrame:
    """Members, messages (sum of weights when present) and date range per cluster.

    The range is taken from ``window_start``/``window_end`` if present, else
    from ``timestamp``, else null.
    """
    keys = list(keys)
    cols = set(df.columns)
    msgs = (F.sum(weight_col).cast("long") if weighted and weight_col in cols
            else F.count(F.lit(1)))
    if {"window_start", "window_end"} <= cols:
        start, end = F.min("window_start"), F.max("window_end")
    elif "timestamp" in cols:
        start, end = F.min("timestamp"), F.max("timestamp")
    else:
        start, end = F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("prototypes_count"),
                                 msgs.alias("messages_count"),
                                 start.cast("timestamp").alias("window_start"),
                                 end.cast("timestamp").alias("window_end"))
