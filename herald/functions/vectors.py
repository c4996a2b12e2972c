"""Vector Column expressions on ``ARRAY<FLOAT|DOUBLE>`` (V2, V3).

Arithmetic is done in double; storage may stay float.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col) -> Column:
    return _c(col).cast("array<double>")


def norm(col) -> Column:
    v = as_double(col)
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x * x))


# V2
def unit_normalize(col) -> Column:
    """Divide by the L2 norm (floored at 1e-12); result ``ARRAY<DOUBLE>``."""
    v = as_double(col)
    n = F.greatest(norm(v), F.lit(NORM_FLOOR))
    return F.transform(v, lambda x: x / n)


# V3
def dot(a, b) -> Column:
    """Dot product (cosine for unit vectors) as DOUBLE."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
