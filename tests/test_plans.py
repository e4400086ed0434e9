"""Physical-plan assertions: pushdown, pruning, top-k, broadcast, no Python on the hot path."""

from __future__ import annotations

import pytest

from strata.plans import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "MapInPandas", "MapInArrow",
                "PythonMapInArrow", "PythonUDF", "FlatMapCoGroupsInPandas")

# keys whose result is computed eagerly (writes) are still plain DataFrames afterwards
PLAN_KEYS = sorted(QUERIES)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_python_in_plans(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES), key


def test_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_medals"](spark, SF_SMALL))


def test_rank_filter_gets_group_limit(spark):
    text = QUERIES["curr_rank"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


def test_bucketed_windows_read_their_input_once(spark):
    for key in ("curr_running_total", "curr_lag_lead"):
        df = QUERIES[key](spark, SF_SMALL)
        df.collect()
        text = plan(df).split("== Initial Plan ==")[0]
        assert text.count("FileScan") == 1, key


def test_hwm_filter_reaches_parquet(spark):
    text = plan(QUERIES["incremental_hwm"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in text


def test_scan_prunes_columns_and_pushes_filter(spark):
    text = plan(QUERIES["scan_parquet"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(o_orderdate," in text
