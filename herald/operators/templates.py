"""Normalise + hash every message, then one row per template.

The dedupe is a single hash aggregate on ``(originator_id, template_hash)``;
``min_by`` and ``count`` are partial aggregates, so a template that holds a third
of all rows still leaves each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.functions.hashing import template_hash
from herald.functions.text import normalize_messages


# T18
def normalize_and_hash(messages: DataFrame, text_col: str = "raw_text", seed: int = 0,
                       drop_null_text: bool = True, spread: int | None = None) -> DataFrame:
    """Add ``normalized_text`` and ``template_hash``.

    Null texts are dropped; :func:`null_text_counts` reports how many. ``spread``
    deals the rows to that many tasks first, for an input that arrives in fewer
    splits than there are task slots; a large input needs none.
    """
    df = messages.filter(F.col(text_col).isNotNull()) if drop_null_text else \
        messages.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("nan")))
    df = df.repartition(spread) if spread else df
    df = normalize_messages(df, text_col=text_col, out_col="normalized_text")
    return df.withColumn("template_hash", template_hash("normalized_text", seed))


def null_text_counts(messages: DataFrame, text_col: str = "raw_text",
                     key: str = "originator_id") -> DataFrame:
    """Messages and dropped null texts per sender (T18's report)."""
    return messages.groupBy(key).agg(F.count(F.lit(1)).alias("n_messages"),
                                     F.count_if(F.col(text_col).isNull()).alias("n_null_text"))


# A1
def dedupe_by_hash(df: DataFrame, hash_col: str = "template_hash",
                   key_cols=("originator_id",), order_col: str = "seq",
                   carry=("message_id", "normalized_text")) -> DataFrame:
    """First row (lowest ``order_col``) per key + hash, with ``count_in_window``."""
    keys = [*key_cols, hash_col]
    carried = [c for c in carry if c in df.columns and c not in keys]
    first = F.min_by(F.struct(*[F.col(c) for c in carried], F.col(order_col).alias("seq")),
                     F.col(order_col)).alias("_first")
    agg = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("count_in_window"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in carried],
                      F.col("_first.seq").alias("seq"), "count_in_window")


def build_templates(messages: DataFrame, seed: int = 0, spread: int | None = None) -> DataFrame:
    """Message batch -> templates ``originator_id, template_hash, message_id,
    normalized_text, seq, count_in_window``."""
    return dedupe_by_hash(normalize_and_hash(messages, seed=seed, spread=spread))


def top_templates(templates: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` templates per originator by ``count_in_window`` (ties: hash)."""
    from pyspark.sql import Window
    w = Window.partitionBy("originator_id").orderBy(F.desc("count_in_window"), "template_hash")
    return templates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
