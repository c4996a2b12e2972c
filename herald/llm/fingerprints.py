"""Document fingerprints (SimHash) and their search, in DataFrame functions only.

*Fingerprint*: the terms of a text are its lower-cased word pairs (its word, if it
has one); a pair weighs as many votes as it has characters, 15 at most. Each
term's 64-bit hash votes for or against every bit. The votes are plain sums,
two 32-bit counters to a long, so a text of any length is folded as its terms
stream by and nothing but 33 longs per text is ever kept.

*Search*: the 64 bits are cut into five blocks. Fingerprints within three bits
agree on at least two of them, so each of the ten tables keyed by two blocks
(about 25 bits) is joined on equality, and the distance decides inside the
join. A pair is reported by the first table it agrees in.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.llm.common import WORD_PATTERN, Scratch

MAX_WEIGHT = 15
LANES = 0x1_0000_0001
RADIUS = 3
BLOCKS = 5
ROWS_PER_BUCKET = 4096
CUTS = 64


def terms(text: Column) -> Column:
    """Lower-cased word pairs of a text; a single word stands alone."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))
    # binding by a one-element array, as the words are used more than once
    return F.transform(F.array(words), lambda w: F.when(F.size(w) < 2, w).otherwise(
        F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1),
                   lambda a, b: F.concat(a, F.lit(" "), b))))[0]


def vote_sums(term: Column) -> list[Column]:
    """Aggregates over exploded terms: ``w`` and ``v0`` .. ``v31``, two counters in each."""
    weight = F.when(term.isNull(), 0).otherwise(F.least(F.length(term), F.lit(MAX_WEIGHT))).cast("long")
    h = F.xxhash64(term)
    return [F.sum(weight).alias("w")] + [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANES)) * weight).alias(f"v{i}")
        for i in range(32)]


def fingerprint_of_sums() -> Column:
    """The bits that more than half of the weight ``w`` voted for, as a signed long."""
    def bit(i: int) -> Column:
        lane = F.col(f"v{i % 32}")
        votes = lane.bitwiseAND(F.lit(0xFFFF_FFFF)) if i < 32 else F.shiftrightunsigned(lane, 32)
        value = (1 << i) - (1 << 64 if i == 63 else 0)
        return F.when(votes * 2 > F.col("w"), F.lit(value)).otherwise(F.lit(0)).cast("long")
    return reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(64)])


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, fp): the fingerprint of each row; ``keys`` must tell the rows apart.

    A text without words has fingerprint zero.
    """
    exploded = rows.select(*keys, F.explode_outer(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
    return exploded.groupBy(*keys).agg(*vote_sums(F.col("term"))) \
        .select(*keys, fingerprint_of_sums().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hex_digits(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_bounds(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(shift, width) of each block of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def near_pairs(queries: DataFrame, rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, fp, bits): each fingerprint ``fp`` of ``rows`` within ``radius`` of a ``q`` of ``queries``.

    Both sides should hold different fingerprints; a fingerprint is near itself.
    """
    def block(fp: Column, b: tuple[int, int]) -> Column:
        return F.shiftrightunsigned(fp, b[0]).bitwiseAND(F.lit((1 << b[1]) - 1))

    bounds = block_bounds(blocks)
    tables = list(combinations(range(blocks), blocks - radius))

    def permuted(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("table"),
                                  *[block(F.col(name), bounds[i]).alias(f"k{j}") for j, i in enumerate(c)])
                         for t, c in enumerate(tables)])
        return df.select(name, F.explode(keys).alias("k")).select(name, "k.*")

    on = ["table", *[f"k{j}" for j in range(blocks - radius)]]
    differing = F.col("q").bitwiseXOR(F.col("fp"))
    # equal blocks of a pair, the earliest of which name the table that reports it
    equal = [block(differing, b) == 0 for b in bounds]
    first = F.coalesce(*[F.when(reduce(lambda a, b: a & b, [equal[i] for i in c]), F.lit(t))
                         for t, c in enumerate(tables)])
    left, right = permuted(queries, "q").alias("l"), permuted(rows, "fp").alias("r")
    match = reduce(lambda a, b: a & b, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on])
    return left.join(right, match & (F.bit_count(differing) <= radius) & (first == F.col("l.table"))) \
        .select("q", "fp", F.bit_count(differing).alias("bits"))


def in_buckets(docs: DataFrame, id_col: str, scratch: Scratch, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``docs`` plus ``bucket``: ranges of about ``rows_per_bucket`` rows in descending id, 0 first.

    Every range that is too full is cut at quantiles of its own ids, into as many ranges as its
    rows ask for, ``CUTS`` at most, as many times over as the row count asks for; so the cuts follow
    the rows, however the ids are spread. Only ids are read for this. The cuts of a level (a row a
    range) are a small table, which Spark broadcasts as long as it is small. Ids are numbers. Equal
    ids share a bucket; null ids come last.
    """
    n = docs.filter(F.col(id_col).isNotNull()).count()
    levels = 0
    while rows_per_bucket * CUTS ** levels < n:
        levels += 1
    quantiles = [i / CUTS for i in range(1, CUTS)]
    # of the quantiles of a range every so many-th, and of equal ones one
    parts = F.least(F.ceil(F.col("n") / rows_per_bucket), F.lit(CUTS)).cast("int")
    chosen = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("parts") - 1),
                                          lambda i: F.get("q", F.floor(i * CUTS / F.col("parts")).cast("int") - 1)))

    def below(rows: DataFrame, cuts: DataFrame) -> DataFrame:
        part = F.size(F.filter("cuts", lambda c: c >= F.col(id_col)))
        return rows.join(cuts, "bucket", "left").withColumn(
            "bucket", F.col("bucket") * CUTS + F.when(F.col("cuts").isNull(), 0).otherwise(part)).drop("cuts")

    first = F.when(F.col(id_col).isNull(), F.lit(None)).otherwise(F.lit(0)).cast("long")
    ids, placed = docs.select(id_col).withColumn("bucket", first), docs.withColumn("bucket", first)
    for _ in range(levels):
        cuts = scratch.write(
            ids.filter(F.col(id_col).isNotNull()).groupBy("bucket")
            .agg(F.count("*").alias("n"), F.percentile_approx(id_col, quantiles, 20 * CUTS).alias("q"))
            .withColumn("parts", parts).filter("parts > 1").select("bucket", chosen.alias("cuts")))
        ids, placed = below(ids, cuts), below(placed, cuts)
    return placed.withColumn("bucket", F.coalesce("bucket", F.lit(1 << 62)))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        radius: int = RADIUS, search_every: int = 20) -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced by the next one's start.

    The next document is the next lower id; after the last comes the first. Per row:
    id, ``n_chars``, ``edited_sha256``, ``fp``, ``edited_fp``, ``near_edited``, ``near_next``
    (share of equal bits with the edited text's and the next document's
    fingerprint) and, for ids divisible by ``search_every``, ``n_near``: how many
    other rows have a fingerprint within ``radius`` bits. Null texts count as empty;
    rows with equal ids follow in order of their texts; null ids come last; a
    single document is its own next; an empty table gives an empty one. Other
    columns are not read.

    Texts are shuffled once, into ranges of ids; edited texts, votes and neighbours
    all come from that layout. The one row of each range whose next document
    lies in another range gets it from the ranges' first rows.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    plain = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = in_buckets(plain, id_col, scratch)
    down = Window.partitionBy("bucket").orderBy(F.col(id_col).desc_nulls_last(), "text")

    # the buckets' order, as a ring: one slim row per bucket
    ring = scratch.few(placed.select("bucket").distinct().withColumn(
        "after", F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")),
                            F.max("bucket").over(Window.partitionBy()))))
    numbered = placed.withColumn("rn", F.row_number().over(down))
    # a bucket's last text is followed by the first text of the next bucket
    heads = numbered.filter("rn = 1").join(ring, "bucket") \
        .select(F.col("after").alias("bucket"), F.col("text").alias("head_text"))
    numbered = numbered.withColumn("next_text", F.lead("text").over(down))
    n, third = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    with_next = numbered.join(heads.hint("merge"), "bucket", "left") \
        .withColumn("next_text", F.coalesce("next_text", "head_text"))
    edited = with_next.select(
        "bucket", "rn", F.col(id_col).alias("id"), n.cast("long").alias("n_chars"), "text",
        F.concat(F.substring("text", F.lit(1), n - third),
                 F.substring("next_text", F.lit(1), third)).alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "rn", "id", "n_chars", "edited_sha256"]
    versions = edited.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("v")) \
        .select(*keys, "v.kind", "v.body")
    both = fingerprints(versions, [*keys, "kind"], "body").groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    by_row = Window.partitionBy("bucket").orderBy("rn")
    done = scratch.write(both.withColumn("next_fp", F.lead("fp").over(by_row)))

    firsts = done.filter("rn = 1").select("bucket", F.col("fp").alias("head_fp")) \
        .join(ring, "bucket").select(F.col("after").alias("bucket"), "head_fp")
    linked = done.join(firsts, "bucket", "left") \
        .withColumn("next_fp", F.coalesce("next_fp", "head_fp"))

    classes = scratch.few(done.groupBy("fp").agg(F.count("*").alias("rows")))
    asked = F.col("id") % search_every == 0
    pairs = near_pairs(done.filter(asked).select(F.col("fp").alias("q")).distinct(),
                       classes.select("fp"), radius)
    near = scratch.few(pairs.join(classes, "fp").groupBy("q").agg((F.sum("rows") - 1).alias("n_near")))
    return linked.join(near, linked["fp"] == near["q"], "left").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"))
