"""Per-sender selection and thinning.

Match positions are computed without a window over a whole sender: rows are
cut into fixed ``seq`` buckets, per-bucket counts (a small table) give each
bucket's offset, and only a bucket is ever sorted in one task. A sender with
a third of all rows is therefore spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald import config
from herald.session import cut_lineage

BUCKET_ROWS = 1 << 20


def bucket_counts(df: DataFrame, key: str, order: str, bucket_rows: int) -> DataFrame:
    """``key, __bucket, __n``: rows per sender and range of ``order`` (a small table)."""
    return df.groupBy(key, F.floor(F.col(order) / bucket_rows).alias("__bucket")) \
        .agg(F.count(F.lit(1)).alias("__n"))


def match_position(df: DataFrame, key: str = "originator_id", order: str = "seq",
                   out: str = "match_pos", bucket_rows: int = BUCKET_ROWS,
                   counts: DataFrame | None = None) -> DataFrame:
    """1-based position of each row among the rows of its ``key``, by ``order``."""
    b = "__bucket"
    counts = bucket_counts(df, key, order, bucket_rows) if counts is None else counts
    w = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    rn = F.row_number().over(Window.partitionBy(key, b).orderBy(order))
    return (df.withColumn(b, F.floor(F.col(order) / bucket_rows)).withColumn("__rn", rn)
              .join(offsets, [key, b])
              .withColumn(out, (F.col("__off") + F.col("__rn")).cast("long"))
              .drop(b, "__rn", "__off"))


# F3
def thin_by_input_position(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    return df.filter(F.col(order) % n == 0)


# F4
def thin_by_match_position(df: DataFrame, n, key: str = "originator_id",
                           order: str = "seq") -> DataFrame:
    """Keep every ``n``-th row of each sender (``n`` an int or a column)."""
    nn = F.lit(n) if isinstance(n, int) else n
    return match_position(df, key, order).filter(F.col("match_pos") % nn == 0).drop("match_pos")


# A2
def matches_per_originator(df: DataFrame, key: str = "originator_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_matches"))


# F5
def dilution(target_rows: int):
    return F.greatest(F.lit(1), F.ceil(F.col("n_matches") / F.lit(target_rows))).cast("long")


def dilute_factors(df: DataFrame, target_rows: int = config.TARGET_ROWS,
                   key: str = "originator_id") -> DataFrame:
    """``max(1, ceil(count / target_rows))`` per sender with at least one row."""
    return matches_per_originator(df, key).withColumn("dilute", dilution(target_rows))


def adaptive_thin(df: DataFrame, target_rows: int = config.TARGET_ROWS, key: str = "originator_id",
                  order: str = "seq", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """thin each sender towards ``target_rows`` by its own factor; ``order`` is unique in a sender.

    Bucket counts, written once, give both the offsets and the senders' totals.
    Only (sender, position) is sorted and numbered; whole rows meet the kept
    positions in one join. Two scans read two columns, one reads the rows.
    """
    counts = cut_lineage(bucket_counts(df, key, order, bucket_rows))
    total = counts.groupBy(key).agg(F.sum("__n").alias("n_matches"))
    factor = total.select(key, dilution(target_rows).alias("dilute"))
    kept = match_position(df.select(key, order), key, order, bucket_rows=bucket_rows, counts=counts) \
        .join(factor, key).filter(F.col("match_pos") % F.col("dilute") == 0).select(key, order)
    return df.join(kept, [key, order], "left_semi")


# F7
def originator_list(reg: DataFrame, col: str = "business_number") -> DataFrame:
    return reg.select(F.col(col).cast("string").alias("originator_id")).distinct()


# F6
def originator_list_filtered(reg: DataFrame, col: str = "business_number",
                             min_len: int = 5) -> DataFrame:
    """Distinct, non-null senders longer than 4 characters, sorted."""
    o = F.col(col).cast("string")
    return (reg.filter(F.col(col).isNotNull()).select(o.alias("originator_id")).distinct()
               .filter(F.length("originator_id") >= min_len).orderBy("originator_id"))


# F2
def filter_registered(messages: DataFrame, reg: DataFrame, col: str = "business_number",
                      key: str = "originator_id") -> DataFrame:
    """Messages whose sender is registered (semi join; AQE broadcasts the list
    when its measured size is under the broadcast threshold)."""
    return messages.join(originator_list(reg, col), key, "left_semi")
