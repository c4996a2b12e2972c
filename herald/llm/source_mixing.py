"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words (:func:`source_targets`). A target of
``r`` times the source's words gives each document ``floor(r)`` certain copies;
the fraction left is drawn without replacement: documents are ranked by their
random odds ``u / (1 - u)`` divided by their inclusion odds ``p / (1 - p)``, and
the lowest ranks are taken until the source's remaining words are reached. The
sample's size in words is fixed, and a document's chance of a further copy is
close to ``p``.

No source is sorted in one task, though one may hold a third of all rows. Ranks fall
into ``BUCKETS`` ranges per source whose words are summed first; only the range
that holds the cut is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.llm.common import WORD_PATTERN, Scratch

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096


def uniform(*cols: str) -> Column:
    """A number in (0, 1) from 52 bits of an MD5, which other engines can recompute."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)


def source_targets(totals: DataFrame, source: str, weights=WEIGHTS, max_copies: int = MAX_COPIES
                   ) -> DataFrame:
    """``target`` per row of ``totals`` (``source``, ``source_size``).

    Sources in code-point order, null last, weigh ``weights`` in turn and share the
    sum of all sizes. A target stops at ``max_copies`` times its source's size; the
    excess is shared again by weight until no target is above. That ends in one
    level ``t`` with ``target = min(cap, weight * t)``: going through the sources by cap
    per weight, ``t`` is what the sources not yet capped would share, at the first
    source that stays below its cap. ``totals`` has one row per source, so these
    windows see as many rows as there are sources.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("nr") - 1, F.lit(len(weights))) + 1).cast("int"))
    x = totals.withColumn("nr", F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))) \
        .withColumn("weight", pick) \
        .withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "nr")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), \
        by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.withColumn("t", (F.sum("source_size").over(everything).cast("double")
                           - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after)) \
        .withColumn("free", F.col("cap") >= F.col("weight") * F.col("t")) \
        .withColumn("rank", F.row_number().over(by_cap))
    level = F.min_by(F.when(F.col("free"), F.col("t")),
                     F.when(F.col("free"), F.col("rank"))).over(everything)
    return x.withColumn("target", F.least("cap", F.col("weight") * level)) \
        .select(source, "source_size", "target", "mean_propensity")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source",
        propensity: str | None = None, weights=WEIGHTS, max_copies: int = MAX_COPIES,
        buckets: int = BUCKETS) -> DataFrame:
    """Per row of ``docs``: id, source, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``size`` is the number of words (0 for a null text), ``copies`` how often the mix
    takes the document and ``taken = copies * size``. ``propensity`` (default: equal)
    names a positive column that scales the chance of the fractional copy within
    a source; a chance of 1 or more is certain. The last document drawn is the one
    that brings the source closest to its target. A document without words
    has the certain copies only. A null source is a source of its own; null ids
    draw by their text; repeated rows are documents of their own and draw with
    the same number, ties going by id, size and row. An empty table gives an
    empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    p = F.col(propensity).cast("double") if propensity else F.lit(1.0)
    sizes = scratch.write(docs.select(
        F.col(id_col), F.col(source),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), p.alias("propensity"),
        F.monotonically_increasing_id().alias("row"))
        .withColumn("u", uniform(id_col, "text_key")).drop("text_key"))

    totals = sizes.groupBy(source).agg(
        F.sum("size").alias("source_size"),
        F.try_divide(F.sum(F.col("propensity") * F.col("size")), F.sum("size")).alias("mean_propensity"))
    targets = scratch.few(source_targets(totals, source, weights, max_copies)
        .withColumn("ratio", F.when(F.col("source_size") > 0,
                                    F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("certain", F.floor("ratio"))
        .withColumn("fraction", F.col("ratio") - F.col("certain"))
        .withColumn("quota", F.col("target") - F.col("certain") * F.col("source_size")))

    def with_source(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed(source, "__source")
        return left.join(right, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")

    chance = F.col("fraction") * F.col("propensity") / F.col("mean_propensity")
    rank = F.when(chance >= 1, 0.0).otherwise(
        F.col("u") / (1 - F.col("u")) * (1 - chance) / chance)
    drawn = with_source(sizes.filter("size > 0"), targets.filter("fraction > 0")) \
        .filter(F.col("fraction").isNotNull()) \
        .select(source, "size", "quota", F.struct(rank.alias("rank"), F.col(id_col).alias("id"), "size",
                                                  "row").alias("place")) \
        .withColumn("bucket", F.floor(buckets * F.col("place.rank") / (1 + F.col("place.rank"))))

    upto = Window.partitionBy(source).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    opened = drawn.groupBy(source, "bucket").agg(F.sum("size").alias("words"),
                                                 F.first("quota").alias("quota")) \
        .withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    crossing = scratch.few(opened.filter(F.col("before") <= F.col("quota")).groupBy(source).agg(
        F.max("bucket").alias("cut_bucket"), F.max("before").alias("before")))

    inside = with_source(drawn, crossing).filter(F.col("bucket") == F.col("cut_bucket"))
    running = Window.partitionBy(source).orderBy("place") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = inside.withColumn("reached", F.col("before") + F.sum("size").over(running)) \
        .filter(F.col("reached") <= F.col("quota")) \
        .groupBy(source).agg(F.max("place").alias("cut"), F.max("reached").alias("reached"))
    cuts = scratch.few(with_source(crossing, reached).select(
        source, "cut_bucket", "cut", F.coalesce("reached", "before").alias("reached")))

    def below(c: DataFrame) -> Column:
        return (F.col("bucket") < F.col("cut_bucket")) | (
            (F.col("bucket") == F.col("cut_bucket")) & F.coalesce(F.col("place") <= F.col("cut"),
                                                                  F.lit(False)))

    gap = F.abs(F.col("quota") - F.col("reached") - F.col("size"))
    closing = with_source(drawn, cuts).filter(~below(drawn)) \
        .filter(gap < F.col("quota") - F.col("reached")) \
        .groupBy(source).agg(F.min(F.struct(gap.alias("gap"), "place")).alias("closing"))
    ends = scratch.few(with_source(cuts, closing).select(
        source, "cut_bucket", "cut", F.col("closing.place").alias("closing")))

    full = with_source(with_source(sizes, targets), ends)
    place = F.struct(rank.alias("rank"), F.col(id_col).alias("id"), "size", "row")
    full = full.withColumn("place", F.when((F.col("fraction") > 0) & (F.col("size") > 0), place)) \
        .withColumn("bucket", F.floor(buckets * F.col("place.rank") / (1 + F.col("place.rank"))))
    extra = F.coalesce(below(full) | F.coalesce(F.col("place") == F.col("closing"), F.lit(False)),
                       F.lit(False))
    copies = F.col("certain") + extra.cast("long")
    return full.select(F.col(id_col), F.col(source), "row", "size", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each copy, none for documents left out.

    Rows are matched with their copies by position-independent columns (id, source and
    text), so repeated rows share what they are given together.
    """
    key = F.xxhash64(*[F.col(c) for c in (id_col, text_col, source)])
    with_key = docs.withColumn("__key", key)
    taken = mix(docs.withColumn("__key", key), "__key", text_col, source, **options) \
        .groupBy("__key").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    number = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1)))
    placed = with_key.join(taken, "__key").withColumn("__nr", number)
    share = F.floor(F.col("__copies") / F.col("__rows")) + \
        (F.col("__nr") <= F.col("__copies") % F.col("__rows")).cast("int")
    return placed.filter(share > 0).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), share.cast("int")))).select(*docs.columns)
