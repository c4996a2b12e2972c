"""Structured Streaming forms.

Each function works on a batch or a streaming DataFrame; on a stream it adds
a watermark so the windowed state is dropped once a window can no longer
change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.operators.assign import is_known


# R1
def windowed_template_counts(df: DataFrame, window: str = "1 day", ts_col: str = "ts",
                             watermark: str | None = "1 hour", key: str = "originator_id",
                             hash_col: str = "template_hash") -> DataFrame:
    """Messages per (tumbling window, sender, template)."""
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    g = df.groupBy(F.window(ts_col, window).alias("w"), key, hash_col)
    return g.agg(F.count(F.lit(1)).alias("count_in_window")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        key, hash_col, "count_in_window")


# R3
def windowed_coverage(assigned: DataFrame, window: str = "1 day", ts_col: str = "ts",
                      watermark: str | None = "1 hour", key: str = "originator_id") -> DataFrame:
    """Known share and Unknown count per (tumbling window, sender)."""
    if watermark:
        assigned = assigned.withWatermark(ts_col, watermark)
    k = is_known()
    return assigned.groupBy(F.window(ts_col, window).alias("w"), key).agg(
        F.count(F.lit(1)).alias("n_total"), F.avg(k.cast("double")).alias("coverage"),
        F.count_if(~k).alias("n_unknown")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
        "n_total", "coverage", "n_unknown")


def append_to(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Write a watermarked stream's finished windows to a Parquet table."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    return (w.trigger(availableNow=True) if trigger_once else w).start()
