"""Every registered query with an oracle statement matches DuckDB (sf0.001)."""

import pytest

from paths import SF_SMALL
from oracle_compare import compare


def test_catalogue_shapes():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.slow
def test_all_oracles(spark):
    res = compare(spark, SF_SMALL, verbose=False)
    failed = [k for k, v in res.items() if not v]
    assert not failed, failed
