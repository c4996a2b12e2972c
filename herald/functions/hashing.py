"""Seeded 64-bit template hash as 16 hex digits.

``sha2`` is a JVM built-in and exists in DuckDB as ``sha256``, so the same key
can be recomputed outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_hash(col, seed: int = 0) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), c), 256), 1, 16)
