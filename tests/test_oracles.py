"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

from strata.plans import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    r = compare(spark, duck_small, SF_SMALL, key, QUERIES[key], ORACLES.get(key))
    if ORACLES.get(key) is None:
        assert r["rows"] >= 0
        return
    assert r["cols_ok"], r
    assert r["ok"], r


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0
