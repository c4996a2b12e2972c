"""Hard-negative mining by a secondary-sort shuffle of packed pair scores.

Rows are vectors with a label; some rows are anchors. A row's score for an anchor is
the integer inner product of their scaled components. An anchor's positives are its
best rows of the same label; a positive's negatives are the best rows of other
labels whose score lies in a window below the positive's.

1. Anchors meet all rows in tiles (a block of anchors, a block of rows): a matrix
   product a tile, no row more often than there are blocks of anchors. A tile hands on
   at most ``positives`` rows of the same label an anchor, the first of which over all
   tiles are the anchor's positives.
2. The tiles are gone through again with the windows that the positives open; a
   tile hands on at most ``negatives`` rows a window, which are the only ones that can be
   among the first ``negatives`` of all tiles.
3. What is left, positives and candidates, becomes one packed key a pair: anchor,
   descending score, positives before negatives, id. The keys are dealt by anchor
   and sorted inside their partitions by Spark (``repartition`` and
   ``sortWithinPartitions``, the DataFrame form of repartitionAndSortWithinPartitions).
   A streaming iterator opens a window at each positive, hands out negatives until
   the window has its number, and holds nothing of an anchor but its open windows.

The result is exact; candidates are only left out where enough better ones of the same
tile and window stand before them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.llm.common import Scratch

ROW_BLOCK = 4096
ANCHOR_BLOCK = 8192
#: Anchors of a tile whose scores are held at once.
STRIPE = 256
LIMIT = (1 << 63) - 1
#: Stands for "not a candidate"; scores are kept above it.
NONE = -LIMIT - 1

PAIRS = "anchor long, id long, score long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def usable(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, q``: one row per id that takes part, components scaled and floored to longs."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    x = df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & whole)
    x = x.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                 F.transform(vec, lambda c: F.floor(c * scale)).alias("q"))
    return x.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Long lists as a matrix, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    wide = int(lengths.max(initial=0))
    if (lengths == wide).all():
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide), dtype=np.int64)
    out[np.arange(wide) < lengths[:, None]] = flat
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices, kept inside 64 bits."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    if not wide:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if bound * wide < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -LIMIT, LIMIT).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's first ``k`` scores: highest first, ties by smaller column."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k, None]
        row, col = np.nonzero((scores >= least) & (scores > NONE))
    else:
        row, col = np.nonzero(scores > NONE)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - first < k
    return row[keep], col[keep]


def _bounds(positive: int, low: int, high: int) -> tuple[int, int]:
    """Scores ``n`` with ``low * positive <= 100 * n <= high * positive``."""
    return -(-low * positive // 100), high * positive // 100


def _tile(mode: str, k: int, low: int, high: int) -> Callable:
    """Pairs of one tile: same-label rows, or rows of other labels inside the anchors' windows."""
    names = ["anchor", "id", "score"]

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [np.empty((3, 0), dtype=np.int64)]
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            ids, labels, q = rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["q"])
            for start in range(0, anchors.num_rows, STRIPE):
                some = anchors.slice(start, STRIPE)
                aid, scores = some["anchor"].to_numpy(), _scores(_matrix(some["aq"]), q)
                same = some["own"].to_numpy()[:, None] == labels
                if mode == "positives":
                    found = [_best(np.where(same & (aid[:, None] != ids), scores, NONE), k)]
                else:
                    windows = some["windows"].to_pylist()
                    found = []
                    for w in range(max(map(len, windows))):
                        # an impossible window for anchors with fewer positives
                        lim = np.array([_bounds(x[w], low, high) if w < len(x) else (1, 0) for x in windows])
                        inside = ~same & (scores >= lim[:, :1]) & (scores <= lim[:, 1:])
                        found.append(_best(np.where(inside, scores, NONE), k))
                pairs = np.unique(np.concatenate([np.stack(f, axis=1) for f in found]), axis=0)
                row, col = pairs[:, 0], pairs[:, 1]
                out.append(np.stack([aid[row], ids[col], scores[row, col]]))
        return pa.table(list(np.concatenate(out, axis=1)), names=names)

    return run


def _meet(anchors: DataFrame, rows: DataFrame, n_anchor_blocks: int, n_row_blocks: int, run: Callable) -> DataFrame:
    """``run`` over every tile; both sides are copied once per block of the other."""
    def blocks(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("arb", blocks(n_row_blocks)).groupBy("ab", "arb")
    r = rows.withColumn("rab", blocks(n_anchor_blocks)).groupBy("rab", "rb")
    return a.cogroup(r).applyInArrow(run, PAIRS)


def pack_key(anchor: str, score: str, kind: int, other: str) -> Column:
    """Bytes whose order is: anchor, descending score, kind, id."""
    def ordered(x: Column) -> Column:
        # the sign bit turned over makes byte order the order of the numbers
        return F.unhex(F.lpad(F.hex(x.bitwiseXOR(F.lit(-LIMIT - 1))), 16, "0"))
    return F.concat(ordered(F.col(anchor)), ordered(F.bitwise_not(F.col(score))),
                    F.lit(bytes([kind])), ordered(F.col(other)))


def _unpack(key: bytes) -> tuple[int, int, int, int]:
    turn = 1 << 63
    anchor, score, other = (int.from_bytes(key[i:i + 8], "big") - turn for i in (0, 8, 17))
    return anchor, ~score, key[16], other


def _stream(positives: int, negatives: int, low: int, high: int) -> Callable:
    """Rows of ``RESULT`` from sorted keys; state is the open windows of one anchor."""
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
                        ("negative_id", pa.int64()), ("positive_score", pa.int64()),
                        ("negative_score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, opened, windows = None, 0, []
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                anchor, score, kind, other = _unpack(key)
                if anchor != now:
                    now, opened, windows = anchor, 0, []
                if kind == 0:
                    if opened < positives:
                        opened += 1
                        windows.append([other, score, *_bounds(score, low, high), 0])
                    continue
                for w in windows:
                    if w[2] <= score <= w[3] and w[4] < negatives:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], other, w[1], score))
                # a window is over when it is full or scores have fallen below it
                windows = [w for w in windows if w[4] < negatives and score >= w[2]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*out), schema)] if out
                else [pa.array([], t.type) for t in schema], schema=schema)

    return run


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on a column ``id``. A component ``x`` counts as
    ``floor(scale * x)``. Higher scores come first, ties by smaller id. A positive's negatives
    are the first ``negatives`` rows of other labels with ``low * positive_score <=
    100 * negative_score <= high * positive_score``; ``rank`` counts them from 1.

    Rows with a null id, label or vector, or a null or non-finite component take no part.
    Of rows with one id, the one with the smallest label and then vector stands for all.
    Shorter vectors count as filled up with zeros, an empty one scores 0 everywhere; very
    long ones only make tiles larger. Scaled components and scores beyond 64 bits stop there.
    Anchors without positives, and positives without negatives, have no rows; an empty table
    gives an empty result. Other columns are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    rows = scratch.write(usable(df, id_col, vec_col, label_col, scale))
    # names of their own: both sides of the tiles come from one table
    anchors = rows.filter(is_anchor).withColumnsRenamed({"id": "anchor", "label": "own", "q": "aq"})
    n_rows, n_anchors = rows.count(), anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    n_rb, n_ab = -(-n_rows // ROW_BLOCK), -(-n_anchors // ANCHOR_BLOCK)
    rows = rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(n_rb)).cast("int"))
    anchors = anchors.withColumn("ab", F.pmod(F.xxhash64("anchor", F.lit(1)), F.lit(n_ab)).cast("int"))

    near = _meet(anchors, rows, n_ab, n_rb, _tile("positives", positives, low, high))
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = scratch.write(near.withColumn("nr", F.row_number().over(first)).filter(F.col("nr") <= positives)
                         .select("anchor", "id", "score"))
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), False).alias("windows"))
    opening = anchors.join(windows, "anchor")
    far = _meet(opening, rows, n_ab, n_rb, _tile("negatives", negatives, low, high))

    keys = best.select("anchor", pack_key("anchor", "score", 0, "id").alias("key")) \
        .unionAll(far.select("anchor", pack_key("anchor", "score", 1, "id").alias("key")))
    dealt = keys.repartition("anchor").sortWithinPartitions("key").select("key")
    return dealt.mapInArrow(_stream(positives, negatives, low, high), RESULT)
