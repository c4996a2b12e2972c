"""Nearest centre by blocked matrix products.

Rows meet the centres of their group in blocks: a block is at most about
``block_rows`` rows and ``center_rows`` centres, whatever the size of the group, and
costs one numpy product. Centres are shipped once per block, never once per
row, and only ids and vectors enter Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
CENTER_ROWS = 2048
NORM_FLOOR = 1e-12


def unit_matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as unit vectors in double (norm floored)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), NORM_FLOOR)


def nearest_center(rows: DataFrame, centers: DataFrame, keys, id_col: str = "template_hash",
                   vec_col: str = "embedding", center_id: str = "row_index",
                   center_vec: str = "centroid", block_rows: int = BLOCK_ROWS,
                   center_rows: int = CENTER_ROWS) -> DataFrame:
    """``keys, id, center_id, score``: the centre of highest cosine in the row's group.

    Ties go to the lowest ``center_id`` (an integer). Rows without a vector and rows
    of groups without centres have no result; ``id_col`` must be unique in a group.
    """
    keys = list(keys)
    rows = rows.filter(F.col(vec_col).isNotNull()).select(
        *keys, F.col(id_col).alias("__id"), F.col(vec_col).cast("array<float>").alias("__v"))
    centers = centers.select(*keys, F.col(center_id).cast("int").alias("__c"),
                             F.col(center_vec).cast("array<double>").alias("__cv"))
    # one row per group: how many blocks its rows and its centres are dealt into
    split = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).alias("__nr")) \
        .join(centers.groupBy(*keys).agg(F.ceil(F.count("*") / center_rows).alias("__nc")), keys)

    def blocks(df: DataFrame, own: str, n_own: str, other: str, n_other: str, hashed: str) -> DataFrame:
        return df.join(split, keys).withColumn(own, F.pmod(F.xxhash64(hashed), F.col(n_own))) \
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_other) - 1)))

    by = [*keys, "__rb", "__cb"]
    left = blocks(rows, "__rb", "__nr", "__cb", "__nc", "__id").select(*by, "__id", "__v")
    # fresh attributes on one side: centres may be derived from the same rows
    right = blocks(centers, "__cb", "__nc", "__rb", "__nr", "__c") \
        .select(*[F.col(c).alias(c) for c in (*by, "__c", "__cv")])
    types = dict(rows.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"__id {types['__id']}", "__c int", "score double"])

    def run(group: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            a, c, s = a.slice(0, 0), np.zeros(0, dtype=np.int32), np.zeros(0)
        else:
            b = b.sort_by("__c")
            scores = unit_matrix(a["__v"]) @ unit_matrix(b["__cv"]).T
            best = scores.argmax(axis=1)  # the first of equal ones, so the lowest id
            c, s = b["__c"].to_numpy()[best].astype(np.int32), scores[np.arange(len(best)), best]
        return pa.Table.from_arrays([a[k] for k in keys] + [a["__id"], pa.array(c), pa.array(s)],
                                    names=[*keys, "__id", "__c", "score"])

    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, schema)
    best = found.groupBy(*keys, "__id").agg(F.max(F.struct("score", (-F.col("__c")).alias("low"))).alias("b"))
    return best.select(*keys, F.col("__id").alias(id_col), (-F.col("b.low")).cast("int").alias(center_id),
                       F.col("b.score").alias("score"))
