"""SimHash near-dedup: tiled exact comparison of all fingerprints.

1. Arrow tasks turn each text into a 64-bit SimHash of its word shingles.
2. Rows with equal fingerprints form one class; only classes are compared.
3. Classes are dealt into tiles by population count. Two fingerprints within the
   radius differ by at most the radius in population count, so tile pairs
   further apart are never made. The remaining pairs are compared exactly with
   numpy exclusive-or and bit counts. Inside a task, rows are grouped by the
   counts of parts of the word, which skips blocks by the same bound.
4. A task reports a spanning forest of the links it found (at most one link per
   row), never all pairs, and the forests are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.llm.common import Scratch, slices, utf8
from herald.llm.components import component_labels

SHINGLE_WORDS = 3
RADIUS = 3
TILE_ROWS = 16384
BLOCK = 1 << 20
HASHES_AT_ONCE = 1 << 16
#: From so many classes on, tiles go by the counts of both halves of the word.
TWO_PART_TILES_FROM = 2_000_000


def simhash(text: bytes, n: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """SimHash of the ``n``-word shingles of a text: a bit is set if over half their hashes have it.

    A-Z are lower-cased, words are split at ASCII white space; fewer than ``n``
    words make one shingle, no words give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < n:
        words, n = [b" ".join(words)], 1
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(n)))),
                 repeat(seed))
    total, votes = len(words) - n + 1, np.zeros(64, dtype=np.int64)
    for _ in range(0, total, HASHES_AT_ONCE):
        part = np.fromiter(islice(hashes, HASHES_AT_ONCE), dtype=np.uint64)
        bits = np.unpackbits(part.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
        # eight byte-wide counters to a word; a byte counts to 255
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        votes += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed 64-bit integer (null text: zero)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([simhash(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))],
                                             [id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, fp long")


def hex_digits(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Forest:
    """Union of local rows by least root, in bulk."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def link_tiles(left: np.ndarray, right: np.ndarray | None, radius: int, block: int = BLOCK
               ) -> tuple[np.ndarray, np.ndarray]:
    """(row, root): spanning forest of rows within ``radius``, of one tile or across two.

    Rows number the left tile first. Blocks whose part counts differ by more than
    the radius in sum are skipped.
    """
    both = left if right is None else np.concatenate([left, right])
    forest, offset = Forest(len(both)), 0 if right is None else len(left)
    other = both[offset:]

    def parts(x):
        return np.stack([np.bitwise_count(x >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.int16)
                         for s in (48, 32, 16, 0)], axis=1)

    def grouped(x):
        groups, inverse = np.unique(parts(x)[:, [0, 2]], axis=0, return_inverse=True)
        order = np.argsort(inverse.ravel(), kind="stable")
        return groups, order, np.append(0, np.cumsum(np.bincount(inverse.ravel())))

    parts_other = parts(other)
    groups, order, ends = grouped(left)
    parts_left = parts(left)
    for g in range(len(groups)):
        mine = order[ends[g]:ends[g + 1]]
        mine_parts = parts_left[mine]
        low, high = mine_parts.min(axis=0), mine_parts.max(axis=0)
        # distance of each other row's counts from the box of this group's counts
        away = np.maximum(np.maximum(low - parts_other, parts_other - high), 0).sum(axis=1)
        near = np.flatnonzero(away <= radius)
        if right is None:
            near = near[near >= mine.min()]
        if not len(near):
            continue
        step = max(1, block // len(near))
        theirs = other[near]
        for i in range(0, len(mine), step):
            rows = mine[i:i + step]
            hit = np.bitwise_count(left[rows][:, None] ^ theirs[None, :]) <= radius
            a, b = np.nonzero(hit)
            if len(a):
                forest.join(rows[a], near[b] + offset)
    member = np.flatnonzero(forest.root != np.arange(len(both)))
    return member, forest.root[member]


def tile_pairs(tiles: DataFrame, radius: int, two_parts: bool) -> DataFrame:
    """(pair, a, b): tiles whose population counts differ by no more than the radius."""
    deltas = [(h, s) for h in range(-radius, radius + 1) for s in range(-radius, radius + 1)
              if abs(h) + abs(s) <= radius and (h, s) >= (0, 0)] if two_parts else \
             [(h, 0) for h in range(radius + 1)]
    steps = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(s).alias("s")) for h, s in deltas])
    left = tiles.select(F.col("tile").alias("a"), "p", "q", F.explode(steps).alias("d")) \
        .select("a", (F.col("p") + F.col("d.h")).alias("p"), (F.col("q") + F.col("d.s")).alias("q"),
                ((F.col("d.h") == 0) & (F.col("d.s") == 0)).alias("same"))
    return left.join(tiles.withColumnRenamed("tile", "b"), ["p", "q"]) \
        .filter(~F.col("same") | (F.col("a") <= F.col("b"))) \
        .select(F.xxhash64("a", "b").alias("pair"), "a", "b")


def near_links(classes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS,
               two_parts: bool | None = None) -> DataFrame:
    """(a, b): a spanning forest of the fingerprints ``fp`` of ``classes`` within ``radius``."""
    scratch = Scratch(classes.sparkSession, "tiles")
    if two_parts is None:
        two_parts = classes.count() >= TWO_PART_TILES_FROM
    high, whole = F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count("fp")
    keyed = classes.select("fp", (high if two_parts else whole).cast("int").alias("p"),
                           (whole - high if two_parts else F.lit(0)).cast("int").alias("q"))
    # at most 33 * 33 rows, whatever the input
    sizes = keyed.groupBy("p", "q").agg(F.ceil(F.count("*") / tile_rows).alias("chunks"))
    tiled = scratch.few(keyed.join(F.broadcast(sizes), ["p", "q"]).select(
        "fp", "p", "q", F.concat_ws("/", "p", "q", F.pmod(F.xxhash64("fp"), "chunks")).alias("tile")))
    pairs = scratch.few(tile_pairs(tiled.select("tile", "p", "q").distinct(), radius, two_parts))
    first = tiled.join(pairs, F.col("tile") == F.col("a")) \
        .select("pair", "fp", (F.col("a") == F.col("b")).alias("alone"), F.lit(0).alias("side"))
    second = tiled.join(pairs.filter("a <> b"), F.col("tile") == F.col("b")) \
        .select("pair", "fp", F.lit(False).alias("alone"), F.lit(1).alias("side"))

    def run(group: pa.Table) -> pa.Table:
        fps, side = group["fp"].to_numpy(), group["side"].to_numpy()
        left, right = fps[side == 0], fps[side == 1]
        alone = group["alone"][0].as_py()
        rows, roots = link_tiles(left.view(np.uint64), None if alone else right.view(np.uint64), radius)
        both = left if alone else np.concatenate([left, right])
        return pa.table({"a": both[rows], "b": both[roots]})

    # a pair's work is far larger than its bytes: as many tasks as pairs, not as bytes suggest
    return first.union(second).repartition(max(1, pairs.count()), "pair") \
        .groupBy("pair").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                    tile_rows: int = TILE_ROWS, two_parts: bool | None = None) -> DataFrame:
    """Per row: id, ``fp`` (signed 64-bit fingerprint), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    differing bits, the row's own included. Null and empty texts have
    fingerprint zero, linked like any other. Repeated rows each give a row of the
    same component; a null id never becomes a component's id unless all its ids
    are null. An empty table gives an empty one; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, id_col, text_col, shingle))
    classes = scratch.few(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    links = near_links(classes, radius, tile_rows, two_parts)
    labels = component_labels(links).withColumnRenamed("item", "fp")
    linked = classes.join(labels, "fp")
    lowest = linked.groupBy("label").agg(F.min("least").alias("low"))
    found = scratch.few(classes.join(linked.join(lowest, "label").select("fp", "low"), "fp", "left")
                        .select("fp", F.coalesce("low", "least").alias("component_id")))
    return rows.join(found, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest id stays.

    If several rows have that id, the one with the smallest text hash stays; of
    identical rows, one. A component of null ids keeps one row in the same way.
    """
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumn("__key", F.xxhash64(F.col(id_col), text_key))
    found = near_duplicates(docs.select(F.struct(F.col(id_col).isNull().alias("none"),
                                                 F.col(id_col).alias("id"),
                                                 F.xxhash64(F.col(id_col), text_key).alias("key"))
                                        .alias("who"), text_col), "who", text_col, shingle, radius)
    kept = found.filter(F.col("who") == F.col("component_id")).select(F.col("who.key").alias("__key")) \
        .distinct()
    number = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1)))
    return keyed.join(kept, "__key").withColumn("__nr", number).filter("__nr = 1").select(*docs.columns)
