"""Nearest centre with few centres visited (J2 for senders with very many campaigns).

An inverted file of the centres: a group's centres are dealt to the nearest of a few
pivot centres, and a cell knows its radius. Distances of unit vectors,
``d = sqrt(2 - 2 cos)``, obey the triangle inequality, so no centre of a cell is nearer
than ``d(row, pivot) - radius``. A row first visits the cell of its nearest pivot; then
only those cells whose bound does not exceed the best distance found there. The
result is exact: what is left out cannot win, nor tie with the winner.

Groups with at most ``prune_from`` centres meet them all in one block
(:mod:`herald.operators.blocks`). How much is pruned depends on the vectors; without
structure every cell is visited, at about twice the shuffle of plain blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.operators.blocks import BLOCK_ROWS, CENTER_ROWS, nearest_center, unit_matrix
from herald.session import cut_lineage

MAX_PIVOTS = 256
#: Rounding of a distance that comes out of a matrix product.
SLACK = 1e-6
#: Scores that agree to so many places are a tie, whichever block they come from.
TIE_PLACES = 12


@dataclass
class CenterCells:
    """``centers`` (keys, cell, c, cv) and ``pivots`` (keys, cell, pivot, radius)."""

    centers: DataFrame
    pivots: DataFrame


def _distance(cos: str):
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col(cos)))


def center_cells(centers: DataFrame, keys: list[str], center_rows: int = CENTER_ROWS,
                 max_pivots: int = MAX_PIVOTS) -> CenterCells:
    """Deal ``centers`` (keys, c, cv) of each group to cells of about half of ``center_rows`` centres."""
    sizes = centers.groupBy(*keys).agg(F.least(F.lit(max_pivots), F.ceil(2 * F.count("*") / center_rows)).alias("wanted"))
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("c"), "c"))
    pivots = cut_lineage(centers.withColumn("cell", order).filter(F.col("cell") <= max_pivots).join(sizes, keys)
                         .filter(F.col("cell") <= F.col("wanted")).select(*keys, "cell", F.col("cv").alias("pivot")))
    near = cut_lineage(nearest_center(centers, pivots, keys, "c", "cv", "cell", "pivot"))
    radius = near.groupBy(*keys, "cell").agg(F.max(_distance("score")).alias("radius"))
    return CenterCells(cut_lineage(centers.join(near.drop("score"), [*keys, "c"])),
                       cut_lineage(pivots.join(radius, [*keys, "cell"])))


def cell_bounds(rows: DataFrame, pivots: DataFrame, keys: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``keys, id, v, cells, bounds``: the cell of the nearest pivot first, then every other cell whose least
    possible distance is not above the distance to that pivot, which is a centre itself."""
    split = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).alias("__nr"))
    by = [*keys, "__rb"]
    left = rows.join(split, keys).withColumn("__rb", F.pmod(F.xxhash64("id"), F.col("__nr"))) \
        .select(*by, "id", "v")
    right = pivots.join(split, keys).withColumn("__rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__nr") - 1))) \
        .select(*by, "cell", "pivot", "radius")
    types = dict(rows.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] +
                       [f"id {types['id']}", "v array<float>", "cells array<int>", "bounds array<double>"])

    def run(group: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        cells, bounds = [], []
        if a.num_rows and b.num_rows:
            d = np.sqrt(np.clip(2 - 2 * (unit_matrix(a["v"]) @ unit_matrix(b["pivot"]).T), 0, None))
            least, number = d - b["radius"].to_numpy(), b["cell"].to_numpy().astype(np.int32)
            nearest = d.argmin(axis=1)
            for i, best in enumerate(nearest):
                others = np.flatnonzero(least[i] <= d[i, best] + SLACK)
                visit = np.concatenate([[best], others[others != best]])
                cells.append(number[visit])
                bounds.append(least[i, visit])
        else:
            a = a.slice(0, 0)
        return pa.Table.from_arrays([a[k] for k in keys] + [
            a["id"], a["v"], pa.array(cells, pa.list_(pa.int32())), pa.array(bounds, pa.list_(pa.float64()))],
            names=[*keys, "id", "v", "cells", "bounds"])

    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, schema)


@dataclass
class Search:
    """The two passes: ``first`` and ``second`` say which row visits which cell, ``found`` holds their results."""

    first: DataFrame
    second: DataFrame
    found: DataFrame


def search_cells(rows: DataFrame, cells: CenterCells, keys: list[str], block_rows: int = BLOCK_ROWS,
                 center_rows: int = CENTER_ROWS) -> Search:
    """Visit the nearest cell, then those that may still hold a nearer or equally near centre."""
    bounded = cut_lineage(cell_bounds(rows, cells.pivots, keys, block_rows))
    in_cell = [*keys, "cell"]

    def visit(visits: DataFrame) -> DataFrame:
        return nearest_center(visits, cells.centers, in_cell, "id", "v", "c", "cv", block_rows, center_rows)

    first = bounded.select(*keys, "id", "v", F.col("cells")[0].alias("cell"))
    best = cut_lineage(visit(first))
    limits = best.select(*keys, "id", _distance("score").alias("limit"))
    second = bounded.filter(F.size("cells") > 1).join(limits, [*keys, "id"]) \
        .withColumn("other", F.explode(F.slice(F.arrays_zip("cells", "bounds"), F.lit(2), F.size("cells") - 1))) \
        .filter(F.col("other.bounds") <= F.col("limit") + SLACK) \
        .select(*keys, "id", "v", F.col("other.cells").alias("cell"))
    second = cut_lineage(second)
    return Search(first, second, best.unionByName(visit(second)))


def nearest_center_pruned(rows: DataFrame, centers: DataFrame, keys, id_col: str = "template_hash",
                          vec_col: str = "embedding", center_id: str = "row_index", center_vec: str = "centroid",
                          block_rows: int = BLOCK_ROWS, center_rows: int = CENTER_ROWS,
                          prune_from: int = CENTER_ROWS) -> DataFrame:
    """As :func:`herald.operators.blocks.nearest_center`: ``keys, id, score`` and the nearest centre's id.

    Ties (scores equal to 12 places) go to the lowest ``center_id``. Rows without a vector and rows of
    groups without centres have no result. A zero vector is as far from everything, so it visits every cell.
    """
    keys = list(keys)
    large = cut_lineage(centers.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > prune_from).drop("n"))
    plain = nearest_center(rows.join(large, keys, "left_anti"), centers.join(large, keys, "left_anti"), keys, id_col,
                           vec_col, center_id, center_vec, block_rows, center_rows)
    if large.isEmpty():
        return plain
    few = rows.filter(F.col(vec_col).isNotNull()).join(large, keys, "left_semi").select(
        *keys, F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("v"))
    many = centers.join(large, keys, "left_semi").select(
        *keys, F.col(center_id).cast("int").alias("c"), F.col(center_vec).cast("array<double>").alias("cv"))
    found = search_cells(few, center_cells(many, keys, center_rows), keys, block_rows, center_rows).found
    best = found.groupBy(*keys, "id").agg(
        F.max(F.struct(F.round("score", TIE_PLACES).alias("tie"), (-F.col("c")).alias("low"), "score")).alias("b"))
    return plain.unionByName(best.select(*keys, F.col("id").alias(id_col), (-F.col("b.low")).cast("int").alias(center_id),
                                         F.col("b.score").alias("score")))
