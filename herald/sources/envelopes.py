"""Raw envelope dumps.

A dump is a CSV whose ``Value`` field holds a JSON envelope with
``sourceAddress``, ``requestID`` and ``shortMessage``. Parsing is one
``from_json`` per row; the regex fallback runs only on rows the JSON parser
rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herald import config
from herald.functions.fixed_values import ENVELOPE_FIELDS
from herald.functions.labels import py_strip
from herald.operators.thinning import thin_by_input_position
from herald.session import cut_lineage
from herald.sources.split_csv import read_split_csv

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("sourceAddress", T.StringType()),
    T.StructField("requestID", T.StringType()),
    T.StructField("shortMessage", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])


# S1
def read_envelope_csv(spark: SparkSession, path: str, value_col: str = "Value") -> DataFrame:
    """Scan a dump (header row, UTF-8, quoted multi-line fields) with its input position ``seq``.

    A large file is read by several tasks, see :mod:`herald.sources.split_csv`.
    """
    return read_split_csv(spark, path).select(F.col(value_col).alias("value"), "seq")


def with_input_position(df: DataFrame, col: str = "seq") -> DataFrame:
    """Add a 1-based position in scan order without an RDD round trip.

    Rows are written once with their partition and index, so that counts and
    positions see the same layout. Per-partition row counts (one row per
    partition, which bounds the broadcast) give each partition its offset; the
    position is the offset plus the row's index inside its partition.
    """
    tagged = cut_lineage(df.withColumn("__pid", F.spark_partition_id())
                           .withColumn("__mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                         F.min("__mid").alias("__first"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("__pid", "__off", "__first")), "__pid")
            .withColumn(col, (F.col("__off") + F.col("__mid") - F.col("__first") + 1).cast("long"))
            .drop("__pid", "__mid", "__off", "__first"))


# T19
def clean_envelope(col) -> Column:
    """Trim, strip one pair of outer quotes, un-double quotes, CR/LF/TAB -> space.

    Doubled quotes are un-doubled only when the outer quotes were present, so an
    empty JSON string ``""`` in an unquoted value survives.
    """
    c = F.col(col) if isinstance(col, str) else col
    s = py_strip(c)
    quoted = (F.length(s) >= 2) & s.startswith('"') & s.endswith('"')
    s = F.when(quoted, F.replace(s.substr(F.lit(2), F.length(s) - 2), F.lit('""'), F.lit('"'))) \
         .otherwise(s)
    return F.translate(s, "\r\n\t", "   ")


def _fallback(s: Column, field: str) -> Column:
    pat = ENVELOPE_FIELDS[field]
    return F.when(s.rlike(pat), F.regexp_extract(s, pat, 1))


# T20
def parse_envelopes(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` -> ``originator_id, message_id, raw_text`` (+ every other column).

    A text that is no JSON as it stands is un-doubled, whether it had outer quotes or not; one
    that still is none is searched for its fields.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

    def bad(parsed: str) -> Column:
        return F.col(f"{parsed}._corrupt").isNotNull() | F.col(parsed).isNull()

    single = F.replace(F.col("__env"), F.lit('""'), F.lit('"'))
    out = df.withColumn("__env", clean_envelope(value_col)) \
        .withColumn("__parsed", F.from_json("__env", ENVELOPE_SCHEMA, options)) \
        .withColumn("__env", F.when(bad("__parsed"), single).otherwise(F.col("__env"))) \
        .withColumn("__parsed", F.when(bad("__parsed"), F.from_json("__env", ENVELOPE_SCHEMA, options))
                    .otherwise(F.col("__parsed")))
    env, broken = F.col("__env"), bad("__parsed")
    message = F.replace(_fallback(env, "shortMessage"), F.lit('\\"'), F.lit('"'))
    return (out.withColumn("originator_id", F.when(broken, _fallback(env, "sourceAddress"))
                           .otherwise(F.col("__parsed.sourceAddress")))
               .withColumn("message_id", F.when(broken, _fallback(env, "requestID"))
                           .otherwise(F.col("__parsed.requestID")))
               .withColumn("raw_text", F.when(broken, message).otherwise(F.col("__parsed.shortMessage")))
               .drop("__env", "__parsed", value_col))


def envelope_forms(docs: DataFrame) -> DataFrame:
    """Documents as dump fields in three forms, by doc_id: quoted and doubled, plain JSON, doubled without outer quotes."""
    quoted = envelopes_from_documents(docs)
    inner = F.expr("substr(value, 2, length(value) - 2)")
    form = F.pmod(F.col("seq") - 1, F.lit(3))
    return quoted.withColumn("value", F.when(form == 0, F.col("value"))
                             .when(form == 1, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(inner))


def envelopes_from_documents(docs: DataFrame) -> DataFrame:
    """Documents re-encoded as a dump field (quoted, inner quotes doubled), with ``seq``."""
    js = F.to_json(F.struct(F.col("source").alias("sourceAddress"),
                            F.col("doc_id").cast("string").alias("requestID"),
                            F.col("text").alias("shortMessage")))
    return docs.select(F.concat(F.lit('"'), F.replace(js, F.lit('"'), F.lit('""')), F.lit('"'))
                       .alias("value"), (F.col("doc_id") + 1).cast("long").alias("seq"))


# S2 + F1 + F3
def bounded_scan(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The first ``max_rows`` input positions; all of them unless the caller sets a bound."""
    return df if max_rows is None else df.filter(F.col("seq") <= max_rows)


def extract_originator(parsed: DataFrame, originator: str, max_rows: int | None = None,
                       dilute_factor: int = config.DILUTE_FACTOR) -> DataFrame:
    """Messages of one sender at input positions divisible by ``dilute_factor``."""
    mine = bounded_scan(parsed, max_rows).filter(F.col("originator_id") == F.lit(originator))
    return thin_by_input_position(mine, dilute_factor).select("originator_id", "message_id",
                                                              "raw_text", "seq")
