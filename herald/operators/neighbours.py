"""Exact neighbour search inside each sender (J9), pruned by pivots.

A sender's templates are dealt to the nearest of a few pivot templates. Distances
between unit vectors, ``d = sqrt(2 - 2 cos)``, obey the triangle inequality, so two
cells can hold a pair within ``eps`` only if
``d(pivot_i, pivot_j) <= radius_i + radius_j + eps``; other cell pairs are never
made. Cells are cut into tiles of about ``tile_rows`` rows, and every tile pair left is
one task with one matrix product. A sender that fits one tile is one task.

Tasks emit only what the caller asks for: pairs above a similarity
(:func:`similar_pairs`), nearest distances (:func:`knn_distances`) or, in
:mod:`density`, forests.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.operators.blocks import nearest_center, unit_matrix
from herald.session import cut_lineage

TILE_ROWS = 2048
MAX_PIVOTS = 128
#: Distances of a tile pair held at once.
KNN_CELLS = 1 << 22
#: Rounding of a distance that comes out of a matrix product.
SLACK = 1e-6


def cos_to_dist(cos: float) -> float:
    return float(np.sqrt(max(0.0, 2.0 - 2.0 * cos)))


@dataclass
class Tiling:
    """``rows`` (key, id, vec, tile) and the tile pairs ``pairs`` (key, pair, a, b) within ``eps``."""

    rows: DataFrame
    pairs: DataFrame
    key: str

    def groups(self, extra: DataFrame | None = None, grouped: bool = True):
        """Rows grouped by tile pair: ``key, pair, alone, side, id, vec`` and the columns of ``extra``
        (key, id, ...). The left tile has side 0; a tile paired with itself comes once, ``alone``.
        Without ``grouped`` the rows to be grouped."""
        rows = self.rows if extra is None else self.rows.join(extra, [self.key, "id"])
        k, cols = self.key, [c for c in rows.columns if c not in (self.key, "tile")]
        first = rows.withColumnRenamed("tile", "a").join(self.pairs, [k, "a"]) \
            .select(k, "pair", (F.col("a") == F.col("b")).alias("alone"), F.lit(0).alias("side"), *cols)
        second = rows.withColumnRenamed("tile", "b").join(self.pairs.filter("a <> b"), [k, "b"]) \
            .select(k, "pair", F.lit(False).alias("alone"), F.lit(1).alias("side"), *cols)
        rows = first.unionByName(second)
        return rows.groupBy(k, "pair") if grouped else rows


def tile(df: DataFrame, eps: float, key: str = "originator_id", id_col: str = "template_hash",
         vec_col: str = "embedding", tile_rows: int = TILE_ROWS, max_pivots: int = MAX_PIVOTS) -> Tiling:
    """Deal each sender's rows into cells and tiles, and list the tile pairs that may hold a pair within ``eps``."""
    rows = df.select(key, F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))
    sizes = cut_lineage(rows.groupBy(key).agg(F.count("*").alias("n")))
    large = sizes.filter(F.col("n") > tile_rows)
    if not large.limit(1).count():
        one = rows.withColumn("tile", F.lit("0"))
        pairs = sizes.select(key, F.lit("0|0").alias("pair"), F.lit("0").alias("a"), F.lit("0").alias("b"))
        return Tiling(one, pairs, key)
    # pivots: the rows of smallest id hash, more of them for a larger sender
    wanted = F.least(F.lit(max_pivots), F.ceil(2 * F.col("n") / tile_rows))
    order = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("id"), "id"))
    pivots = cut_lineage(rows.join(large, key).withColumn("cell", order)
                         .filter((F.col("cell") <= max_pivots) & (F.col("cell") <= wanted))
                         .select(key, "cell", F.col("vec").alias("pivot")))
    near = cut_lineage(nearest_center(rows.join(large, key, "left_semi"), pivots, [key], "id", "vec", "cell",
                                      "pivot"))
    cells = near.groupBy(key, "cell").agg(
        F.ceil(F.count("*") / tile_rows).alias("tiles"), F.min("score").alias("worst"))
    placed = near.join(cells, [key, "cell"]).select(
        key, "id", F.concat_ws(".", "cell", F.pmod(F.xxhash64("id"), F.col("tiles"))).alias("tile"))
    dealt = cut_lineage(rows.join(placed, [key, "id"], "left")
                        .withColumn("tile", F.coalesce("tile", F.lit("0"))))

    def close_cells(group: pa.Table) -> pa.Table:
        p = unit_matrix(group["pivot"])
        radius = np.sqrt(np.clip(2 - 2 * group["worst"].to_numpy(), 0, None))
        apart = np.sqrt(np.clip(2 - 2 * (p @ p.T), 0, None))
        i, j = np.nonzero(apart <= radius[:, None] + radius[None, :] + eps + SLACK)
        cell = group["cell"].to_numpy()
        keep = cell[i] <= cell[j]
        i, j = i[keep], j[keep]
        return pa.table({key: group[key].take(pa.array(i)), "ca": cell[i].astype(np.int32),
                         "cb": cell[j].astype(np.int32)})

    key_type = dict(rows.dtypes)[key]
    close = pivots.join(cells, [key, "cell"]).groupBy(key).applyInArrow(
        close_cells, f"`{key}` {key_type}, ca int, cb int")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    left = cells.select(key, F.col("cell").alias("ca"), numbers.alias("ta"))
    right = cells.select(key, F.col("cell").alias("cb"), numbers.alias("tb"))
    pairs = close.join(left, [key, "ca"]).join(right, [key, "cb"]) \
        .filter((F.col("ca") < F.col("cb")) | (F.col("ta") <= F.col("tb"))) \
        .select(key, F.concat_ws(".", "ca", "ta").alias("a"), F.concat_ws(".", "cb", "tb").alias("b")) \
        .withColumn("pair", F.concat_ws("|", "a", "b")).select(key, "pair", "a", "b")
    small = sizes.join(large, key, "left_anti") \
        .select(key, F.lit("0|0").alias("pair"), F.lit("0").alias("a"), F.lit("0").alias("b"))
    return Tiling(dealt, cut_lineage(pairs.unionByName(small)), key)


def sides(group: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """Left rows, right rows (the same for a tile paired with itself) and whether they are the same."""
    group = group.sort_by("id")
    if group["alone"][0].as_py():
        return group, group, True
    side = group["side"].to_numpy()
    return group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1)), False


def similar_pairs(df: DataFrame, min_cos: float, key: str = "originator_id",
                  id_col: str = "template_hash", vec_col: str = "embedding",
                  tile_rows: int = TILE_ROWS, tiling: Tiling | None = None) -> DataFrame:
    """All unordered pairs ``a < b`` of one sender with cosine >= ``min_cos``.

    The output holds every pair by definition; callers that need only groups or
    nearest distances should use the forests and distances instead.
    """
    tiling = tiling or tile(df, cos_to_dist(min_cos), key, id_col, vec_col, tile_rows)

    def run(group: pa.Table) -> pa.Table:
        left, right, alone = sides(group)
        if not left.num_rows or not right.num_rows:
            return pa.table({key: group[key].slice(0, 0), "a": group["id"].slice(0, 0),
                             "b": group["id"].slice(0, 0), "cos": pa.array([], pa.float64())})
        s = unit_matrix(left["vec"]) @ unit_matrix(right["vec"]).T
        i, j = np.nonzero(np.triu(s >= min_cos, 1) if alone else s >= min_cos)
        a, b = left["id"].take(pa.array(i)), right["id"].take(pa.array(j))
        ordered = pa.compute.less(a, b)
        return pa.table({key: left[key].take(pa.array(i)), "a": pa.compute.if_else(ordered, a, b),
                         "b": pa.compute.if_else(ordered, b, a), "cos": s[i, j]})

    types = dict(tiling.rows.dtypes)
    return tiling.groups().applyInArrow(
        run, f"`{key}` {types[key]}, a {types['id']}, b {types['id']}, cos double")


def knn_distances(df: DataFrame, k: int, max_dist: float, key: str = "originator_id",
                  id_col: str = "template_hash", vec_col: str = "embedding",
                  tile_rows: int = TILE_ROWS, tiling: Tiling | None = None) -> DataFrame:
    """Per node, its ``k`` smallest distances to other nodes within ``max_dist``:
    ``key, id, nr, d``, ``nr`` from 1 in ascending order of ``d``.

    Each tile pair emits at most ``k`` candidates per node and a ranked filter,
    which Spark applies before the shuffle too, keeps the ``k`` best.
    """
    tiling = tiling or tile(df, max_dist, key, id_col, vec_col, tile_rows)

    def smallest(m: np.ndarray) -> np.ndarray:
        return np.partition(m, k - 1, axis=1)[:, :k] if k < m.shape[1] else m

    def run(group: pa.Table) -> pa.Table:
        left, right, alone = sides(group)
        out = {key: [], "id": [], "d": []}
        if left.num_rows and right.num_rows:
            x = unit_matrix(left["vec"])
            y = x if alone else unit_matrix(right["vec"])
            of_left, of_right, step = [], np.zeros((len(y), 0)), max(1, KNN_CELLS // len(y))
            for start in range(0, len(x), step):
                d = np.sqrt(np.clip(2 - 2 * (x[start:start + step] @ y.T), 0, None))
                if alone:
                    d[np.arange(len(d)), start + np.arange(len(d))] = np.inf
                else:
                    of_right = smallest(np.concatenate([of_right, smallest(d.T)], axis=1))
                of_left.append(smallest(d))
            for rows, best in ((left, np.concatenate(of_left)), (right, of_right))[:1 if alone else 2]:
                i, j = np.nonzero(best <= max_dist)
                out[key].append(rows[key].take(pa.array(i)))
                out["id"].append(rows["id"].take(pa.array(i)))
                out["d"].append(pa.chunked_array([best[i, j]]))
        empty = group.slice(0, 0)
        return pa.table({key: _joined(out[key], empty[key]), "id": _joined(out["id"], empty["id"]),
                         "d": _joined(out["d"], pa.chunked_array([pa.array([], pa.float64())]))})

    types = dict(tiling.rows.dtypes)
    found = tiling.groups().applyInArrow(run, f"`{key}` {types[key]}, id {types['id']}, d double")
    rank = F.row_number().over(Window.partitionBy(key, "id").orderBy("d"))
    return found.withColumn("nr", rank).filter(F.col("nr") <= k).select(key, "id", "nr", "d")


def _joined(parts: list, empty):
    return pa.chunked_array([c for p in parts for c in p.chunks], type=empty.type) if parts else empty
