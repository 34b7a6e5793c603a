"""Every named query against its SQL counterpart, and what no plan may contain."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from binledger.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, con):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_only_models_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"ml_logistic_terms", "ml_tree_vectors"}


def test_entry(spark, data):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert "month_dt" in entry.entry(spark).columns


def test_first_row_choice_is_cut_before_the_shuffle(spark, data):
    plan = QUERIES["latest_row"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filters_and_columns_reach_the_scan(spark, data):
    plan = QUERIES["exclusion_list"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan and "props" not in plan
