"""Message batches and registration tables (S3-S8), built from Spark tables.

A message batch is ``originator_id, message_id, raw_text, seq`` where ``seq`` is
the 1-based input position; every operator orders by ``seq`` instead of relying on
physical row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("originator_id", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("seq", T.LongType()),
])

REGISTRATION_COLUMNS = ("business_number", "description", "campaign_name", "content_type",
                        "call_to_action", "customer_experience")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messages_from_documents(docs: DataFrame) -> DataFrame:
    """``documents`` as a message batch: source is the sender, doc_id the message."""
    return docs.select(
        F.col("source").cast("string").alias("originator_id"),
        F.col("doc_id").cast("string").alias("message_id"),
        F.col("text").alias("raw_text"),
        (F.col("doc_id") + 1).cast("long").alias("seq"),
    )


def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_documents(read_table(spark, sf_dir, "documents"))


# S3
def read_message_csv(spark: SparkSession, path: str) -> DataFrame:
    """A message batch from CSV (header row): the text by S4, ids where there are any, input position."""
    from herald.sources.split_csv import read_split_csv
    return as_message_batch(read_split_csv(spark, path), "seq")


# S4
def resolve_text_column(df: DataFrame) -> str:
    """``raw_text``, else ``text``, else the first string column; error if none."""
    names = df.columns
    if "raw_text" in names:
        return "raw_text"
    if "text" in names:
        return "text"
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            return f.name
    raise ValueError("could not find a text column in the new batch")


# S5 + S4
def as_message_batch(df: DataFrame, seq_col: str | None = None) -> DataFrame:
    """Project any batch to the message schema, carrying ids when present."""
    text = resolve_text_column(df)
    cols = [
        (F.col("originator_id").cast("string") if "originator_id" in df.columns
         else F.lit(None).cast("string")).alias("originator_id"),
        (F.col("message_id").cast("string") if "message_id" in df.columns
         else F.lit(None).cast("string")).alias("message_id"),
        F.col(text).cast("string").alias("raw_text"),
    ]
    if seq_col:
        cols.append(F.col(seq_col).cast("long").alias("seq"))
    elif "seq" in df.columns:
        cols.append(F.col("seq").cast("long").alias("seq"))
    else:
        cols.append(F.monotonically_increasing_id().alias("seq"))
    return df.select(*cols)


# S6 / S7
def require_columns(**frames_and_columns) -> None:
    """Raise one error naming every missing input column.

    ``require_columns(batch=(df, ["raw_text"]), campaigns=(cdf, [...]))``
    """
    missing = []
    for name, (df, cols) in frames_and_columns.items():
        if df is None:
            missing.append(f"{name} (no table)")
            continue
        for c in cols:
            if c not in df.columns:
                missing.append(f"{name}.{c}")
    if missing:
        raise ValueError(f"missing required inputs: {missing}")


def registrations_from_documents(docs: DataFrame) -> DataFrame:
    """One registration row per (source, lang), standing in for the onboarding sheet.

    ``seq`` keeps the sheet order (first document of the pair).
    """
    g = docs.groupBy("source", "lang").agg(F.min("doc_id").alias("seq"),
                                           F.count(F.lit(1)).alias("n_docs"))
    return g.select(
        F.col("source").alias("business_number"),
        F.concat(F.lit("Messages in "), F.col("lang"), F.lit(" sent by "), F.col("source"))
         .alias("description"),
        F.concat(F.col("source"), F.lit(" "), F.col("lang"), F.lit(" notices")).alias("campaign_name"),
        F.lit("text").alias("content_type"),
        F.concat(F.lit("reply to "), F.col("source")).alias("call_to_action"),
        F.concat(F.col("n_docs").cast("string"), F.lit(" messages")).alias("customer_experience"),
        F.col("seq").cast("long").alias("seq"),
    )
