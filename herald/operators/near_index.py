"""Approximate neighbour candidates by random projections (J9), checked exactly.

For vectors that pivots do not prune (:mod:`herald.operators.neighbours`). A table of the
index gives a vector the signs of its products with ``bits`` random directions; two
vectors at angle ``a`` share one sign with probability ``p = 1 - a / pi`` and a whole
bucket with ``p ** bits``. ``tables`` independent tables find a pair with
``1 - (1 - p ** bits) ** tables``, and so many tables are taken that a pair exactly at the
wished cosine is found with probability ``recall``; nearer pairs are found more often.
Bits follow the sender's size, so that a bucket holds about one tile; a sender of one
tile has no bits and is exact.

Where tables are few, rows are shuffled once per table: buckets above one tile are cut into
tiles and all their tile pairs are made, so no bucket is capped and none fills a task. At a low
cosine tables number hundreds; then a sender's rows are dealt into blocks by id and meet by pairs of
blocks, and a task looks up the buckets of all tables itself, so a row is copied once per block
(:func:`_in_blocks`). Both ways report the same pairs.

A pair is reported by the first table whose bucket
both share: no pair is made twice in the output, and none has to be deduplicated. Every
pair reported has the wished cosine; what may be missing are pairs, by ``recall``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.operators.blocks import unit_matrix
from herald.operators.neighbours import TILE_ROWS, Tiling, sides
from herald.session import by_groups, cut_lineage

RECALL = 0.95
MAX_BITS = 48
SEED = 11
#: Rows of a block where rows meet by blocks, and rows or columns of a matrix worked on at once.
BLOCK_ROWS = 8192
CHUNK = 1024
#: Rows multiplied at once: their products stay in a core's cache.
PRODUCT_ROWS = 128
#: From this part of a block pair on, the pairs of a table's buckets are found by comparing all numbers.
FULL = 16


def tables_needed(bits: int, min_cos: float, recall: float) -> int:
    """How many tables of ``bits`` signs find a pair at ``min_cos`` with probability ``recall``."""
    together = (1 - math.acos(max(-1.0, min(1.0, min_cos))) / math.pi) ** bits
    return 1 if together >= 1 else max(1, math.ceil(math.log1p(-recall) / math.log1p(-together)))


def _plan(rows: str, min_cos: float, recall: float, tile_rows: int):
    """(bits, tables) of least work for a sender of ``rows`` rows: a row meets its bucket in each table."""
    n = F.col(rows)
    choices = [F.struct((F.lit(float(t)) * (n / float(2 ** b) + (tile_rows if b else 0))).alias("work"),
                        F.lit(b).alias("bits"), F.lit(t).alias("tables"))
               for b in range(MAX_BITS + 1) for t in [tables_needed(b, min_cos, recall)] if t < 1 << 16]
    return F.array_min(F.array(*choices))


def directions(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """The random directions of all tables, ``dim`` by ``tables * bits``; the same in every task."""
    return np.random.default_rng([seed, dim, bits]).standard_normal((tables * bits, dim)).T


def _planned(df: DataFrame, min_cos: float, recall: float, key: str, id_col: str, vec_col: str, tile_rows: int) -> DataFrame:
    """``key, id, vec, bits, tables, blocks``; rows without a vector are left out."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(
        key, F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))
    sizes = cut_lineage(rows.groupBy(key).agg(F.count("*").alias("n")).withColumn("plan", _plan("n", min_cos, recall, tile_rows)))
    return rows.join(sizes.select(key, "plan.bits", "plan.tables", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")), key)


def bucket_numbers(x: np.ndarray, bits: int, tables: int, seed: int = SEED, made: np.ndarray | None = None) -> np.ndarray:
    """A row per vector, a bucket number per table."""
    out = np.zeros((len(x), tables), dtype=np.int64)
    if not bits:
        return out
    made, values = directions(x.shape[1], bits, tables, seed) if made is None else made, 2.0 ** np.arange(bits)
    step = max(1, 4 * CHUNK // bits)
    for i in range(0, len(x), CHUNK):
        for t in range(0, tables, step):
            sign = x[i:i + CHUNK] @ made[:, t * bits:(t + step) * bits] >= 0
            # doubles hold numbers of up to MAX_BITS bits exactly, and their product is much faster
            out[i:i + CHUNK, t:t + step] = sign.reshape(len(sign), -1, bits).astype(np.float64) @ values
    return out


def signatures(planned: DataFrame, key: str, seed: int) -> DataFrame:
    """``key, id, vec, sig``: one bucket number per table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit_matrix(batch.column("vec"))
            bits, tables = (batch.column(c).to_numpy() for c in ("bits", "tables"))
            sig = [None] * batch.num_rows
            for b, t in {*zip(bits.tolist(), tables.tolist(), strict=True)}:
                at = np.flatnonzero((bits == b) & (tables == t))
                if (b, t) not in made:
                    made[b, t] = directions(x.shape[1], b, t, seed)
                for i, buckets in zip(at, bucket_numbers(x[at], b, t, seed, made[b, t]), strict=True):
                    sig[i] = buckets
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("id"), batch.column("vec"), pa.array(sig, pa.list_(pa.int64()))],
                [key, "id", "vec", "sig"])

    types = dict(planned.dtypes)
    return planned.mapInArrow(run, f"`{key}` {types[key]}, id {types['id']}, vec array<float>, sig array<bigint>")


def sign_tiling(df: DataFrame, min_cos: float, recall: float = RECALL, key: str = "originator_id",
                id_col: str = "template_hash", vec_col: str = "embedding", tile_rows: int = TILE_ROWS,
                seed: int = SEED) -> Tiling:
    """Rows once per table, in tiles of their buckets, and the tile pairs of each bucket of two rows or more."""
    return _sign_tiling(_planned(df, min_cos, recall, key, id_col, vec_col, tile_rows), key, tile_rows, seed)


def _sign_tiling(planned: DataFrame, key: str, tile_rows: int, seed: int) -> Tiling:
    signed = cut_lineage(signatures(planned, key, seed))
    place = [key, "nr", "bucket"]
    buckets = cut_lineage(signed.select(key, F.posexplode("sig").alias("nr", "bucket")).groupBy(*place)
                          .agg(F.count("*").alias("n")).filter("n > 1")
                          .select(*place, F.ceil(F.col("n") / tile_rows).alias("tiles")))
    name = F.concat_ws(".", "nr", "bucket", "part")
    rows = signed.select(key, "id", "vec", "sig", F.posexplode("sig").alias("nr", "bucket")).join(buckets, place) \
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("tiles"))) \
        .select(key, "id", "vec", "sig", "nr", name.alias("tile"))

    def parts(of: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    pairs = buckets.withColumn("i", parts("tiles")).withColumn("j", parts("tiles")).filter("i <= j").select(
        key, F.concat_ws(".", "nr", "bucket", "i").alias("a"), F.concat_ws(".", "nr", "bucket", "j").alias("b")) \
        .withColumn("pair", F.concat_ws("|", "a", "b")).select(key, "pair", "a", "b")
    return Tiling(rows, pairs, key)


def _share(met: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Marks in ``met`` the rows and columns whose bucket numbers ``a`` and ``b`` are equal.

    Work is in proportion to the pairs marked, or to the matrix where buckets are very full.
    """
    cols = np.argsort(b, kind="stable")
    if a.dtype.itemsize <= 2:
        counts = np.bincount(b, minlength=int(a.max()) + 1)
        first, n = (np.cumsum(counts) - counts)[a], counts[a]
    else:
        there = b[cols]
        first = np.searchsorted(there, a, "left")
        n = np.searchsorted(there, a, "right") - first
    ends = np.cumsum(n)
    if ends[-1] > met.size // FULL:
        for k in range(0, len(a), CHUNK):
            met[k:k + CHUNK] |= a[k:k + CHUNK, None] == b
        return
    at = np.arange(ends[-1]) + np.repeat(first - (ends - n), n)
    met.reshape(-1)[np.repeat(np.arange(len(a)) * len(b), n) + cols[at]] = True


def _met(x: np.ndarray, y: np.ndarray, alone: bool, bits: int, tables: int, min_cos: float, seed: int):
    """Rows ``i, j`` of two blocks that share a bucket of a table and have the wished cosine, each pair once."""
    met = np.full((len(x), len(y)), not bits)
    if bits:
        # a table's numbers side by side, as narrow as they can be: they are sorted once per table
        kind = np.min_scalar_type((1 << bits) - 1)
        sx = np.ascontiguousarray(bucket_numbers(x, bits, tables, seed).astype(kind).T)
        sy = sx if alone else np.ascontiguousarray(bucket_numbers(y, bits, tables, seed).astype(kind).T)
        for a, b in zip(sx, sy):
            _share(met, a, b)
    found = [], []
    for k in range(0, len(x), PRODUCT_ROWS):
        close = met[k:k + PRODUCT_ROWS]
        close &= x[k:k + PRODUCT_ROWS] @ y.T >= min_cos
        if alone:
            close &= np.arange(len(y)) > np.arange(k, k + len(close))[:, None]
        i, j = np.nonzero(close)
        found[0].append(i + k)
        found[1].append(j)
    return tuple(np.concatenate(f or [np.zeros(0, dtype=int)]) for f in found)


def _in_blocks(planned: DataFrame, key: str):
    """Rows grouped by the pairs of blocks of their sender, sides as :meth:`Tiling.groups` has them."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = planned.withColumn("own", own).withColumn("other", other).select(
        key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "vec", "bits", "tables",
        (F.col("own") == F.col("other")).alias("alone"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    groups = planned.select(key, "blocks").distinct().agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0]
    return by_groups(rows, int(groups or 0), key, "i", "j")


def _blocks_of(group: pa.Table, min_cos: float, seed: int):
    left, right, alone = sides(group)
    if not left.num_rows or not right.num_rows:
        return None
    x = unit_matrix(left["vec"])
    y = x if alone else unit_matrix(right["vec"])
    return left, right, alone, x, y, _met(x, y, alone, group["bits"][0].as_py(), group["tables"][0].as_py(), min_cos, seed)


def near_pairs_by_signs(df: DataFrame, min_cos: float, recall: float = RECALL, key: str = "originator_id",
                        id_col: str = "template_hash", vec_col: str = "embedding", tile_rows: int = TILE_ROWS,
                        seed: int = SEED) -> DataFrame:
    """Unordered pairs ``a < b`` of one sender with cosine >= ``min_cos``, each once: ``key, a, b, cos``.

    A pair at ``min_cos`` is found with probability ``recall``. Ids must be unique within a sender.
    """
    planned = _planned(df, min_cos, recall, key, id_col, vec_col, tile_rows)
    types = dict(planned.dtypes)
    schema = f"`{key}` {types[key]}, a {types['id']}, b {types['id']}, cos double"

    def block(group: pa.Table) -> pa.Table:
        met = _blocks_of(group, min_cos, seed)
        if met is None:
            return pa.table({key: group[key].slice(0, 0), "a": group["id"].slice(0, 0),
                             "b": group["id"].slice(0, 0), "cos": pa.array([], pa.float64())})
        left, right, _, x, y, (i, j) = met
        cos = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + CHUNK]], y[j[k:k + CHUNK]])
                              for k in range(0, len(i), CHUNK)] or [np.zeros(0)])
        a, b = left["id"].take(pa.array(i)), right["id"].take(pa.array(j))
        ordered = pa.compute.less(a, b)
        return pa.table({key: left[key].take(pa.array(i)), "a": pa.compute.if_else(ordered, a, b),
                         "b": pa.compute.if_else(ordered, b, a), "cos": cos})

    many = F.col("tables") > F.col("blocks")  # fewer copies by blocks than by tables
    return _in_blocks(planned.filter(many), key).applyInArrow(block, schema) \
        .unionByName(_by_tables(planned.filter(~many), min_cos, key, tile_rows, seed, schema))


def _by_tables(planned: DataFrame, min_cos: float, key: str, tile_rows: int, seed: int, schema: str) -> DataFrame:
    tiling = _sign_tiling(planned, key, tile_rows, seed)

    def run(group: pa.Table) -> pa.Table:
        left, right, alone = sides(group)
        if not left.num_rows or not right.num_rows:
            return pa.table({key: group[key].slice(0, 0), "a": group["id"].slice(0, 0),
                             "b": group["id"].slice(0, 0), "cos": pa.array([], pa.float64())})
        s = unit_matrix(left["vec"]) @ unit_matrix(right["vec"]).T
        i, j = np.nonzero(np.triu(s >= min_cos, 1) if alone else s >= min_cos)
        table = left["nr"][0].as_py()
        if table:  # an earlier table in which both share a bucket has reported the pair
            one, two = (np.stack(t["sig"].to_numpy())[:, :table] for t in (left, right))
            new = np.concatenate([~(one[i[k:k + 4096]] == two[j[k:k + 4096]]).any(axis=1)
                                  for k in range(0, len(i), 4096)] or [np.zeros(0, dtype=bool)])
            i, j = i[new], j[new]
        a, b = left["id"].take(pa.array(i)), right["id"].take(pa.array(j))
        ordered = pa.compute.less(a, b)
        return pa.table({key: left[key].take(pa.array(i)), "a": pa.compute.if_else(ordered, a, b),
                         "b": pa.compute.if_else(ordered, b, a), "cos": s[i, j]})

    return tiling.groups().applyInArrow(run, schema)


def recall_by_blocks(df: DataFrame, min_cos: float, recall: float = RECALL, key: str = "originator_id",
                     id_col: str = "template_hash", vec_col: str = "embedding", tile_rows: int = TILE_ROWS,
                     seed: int = SEED) -> DataFrame:
    """:func:`measured_recall` of the index against all products, without a row per pair.

    A pair lies in one pair of blocks, whose task looks it up in the index and among all its
    products and hands on counts alone. Where ids repeat in a sender, counts are of the join's rows.
    """
    planned = _planned(df, min_cos, recall, key, id_col, vec_col, tile_rows)

    def run(group: pa.Table) -> pa.Table:
        met = _blocks_of(group, min_cos, seed)
        counts = np.zeros(3, dtype=np.int64)
        if met is not None:
            left, right, alone, x, y, (fi, fj) = met
            found = np.zeros((len(x), len(y)), dtype=bool)
            found[fi, fj] = True
            names = [t["id"].combine_chunks().dictionary_encode() for t in (left, right)]
            single = all(len(d.dictionary) == len(d) for d in names)
            exact = [], []
            for k in range(0, len(x), PRODUCT_ROWS):
                s = x[k:k + PRODUCT_ROWS] @ y.T >= min_cos
                if alone:
                    s &= np.arange(len(y)) > np.arange(k, k + len(s))[:, None]
                both = np.count_nonzero(s & found[k:k + PRODUCT_ROWS])
                counts += np.count_nonzero(s), both, np.count_nonzero(found[k:k + PRODUCT_ROWS]) - both
                if not single:
                    i, j = np.nonzero(s)
                    exact[0].append(i + k)
                    exact[1].append(j)
            if not single:
                counts = _of_repeated(left["id"], right["id"], tuple(map(np.concatenate, exact)), (fi, fj))
        k = group[key].slice(0, 1)
        return pa.table({key: k, **{c: pa.array([int(v)]) for c, v in zip(("exact", "found", "wrong"), counts)}})

    types = dict(planned.dtypes)
    return _in_blocks(planned, key).applyInArrow(run, f"`{key}` {types[key]}, exact long, found long, wrong long") \
        .groupBy(key).agg(F.sum("exact").alias("n_exact"), F.sum("found").alias("n_found"), F.sum("wrong").alias("n_wrong")) \
        .filter("n_exact + n_wrong > 0") \
        .withColumn("recall", F.when(F.col("n_exact") > 0, F.col("n_found") / F.col("n_exact")).otherwise(1.0))


def _of_repeated(a, b, exact, found) -> tuple[int, int, int]:
    """Exact, found and wrong rows of the join of pairs by their ids, some of which repeat."""
    names = pa.chunked_array([*a.chunks, *b.chunks]).dictionary_encode().unify_dictionaries().combine_chunks()
    code = names.indices.to_numpy().astype(np.int64)
    ca, cb = code[:len(a)], code[len(a):]

    def counted(pairs):
        p, q = ca[pairs[0]], cb[pairs[1]]
        at, n = np.unique(np.minimum(p, q) * len(code) + np.maximum(p, q), return_counts=True)
        return dict(zip(at.tolist(), n.tolist()))

    e, f = counted(exact), counted(found)
    both = sum(n * f[p] for p, n in e.items() if p in f)
    return both + sum(n for p, n in e.items() if p not in f), both, sum(n for p, n in f.items() if p not in e)


def measured_recall(found: DataFrame, exact: DataFrame, key: str = "originator_id") -> DataFrame:
    """``key, n_exact, n_found, n_wrong, recall`` of pairs against the exact ones (no pairs: recall 1)."""
    marks = exact.select(key, "a", "b", F.lit(1).alias("e")).join(
        found.select(key, "a", "b", F.lit(1).alias("f")), [key, "a", "b"], "full")
    return marks.groupBy(key).agg(
        F.count("e").alias("n_exact"), F.count(F.col("e") * F.col("f")).alias("n_found"),
        F.count(F.when(F.col("e").isNull(), 1)).alias("n_wrong")) \
        .withColumn("recall", F.when(F.col("n_exact") > 0, F.col("n_found") / F.col("n_exact")).otherwise(1.0))
