"""The shape of the plans: pushdown, pruning, no Python workers, no products, bounded top-k."""

from pathlib import Path

import pytest

from tallywork.plans.contract import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_worker_and_no_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", ["popular_items", "popular_items_named", "most_connected", "similar_items_cosine"])
def test_top_k_is_kept_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize(
    "name,pushed,read",
    [
        ("min_by_key", "EqualTo(l_returnflag,A)", "l_suppkey:bigint,l_quantity:double,l_returnflag:string"),
        ("select_filter_lt", "LessThan(p_size,21)", "p_partkey:bigint,p_size:int"),
        ("sql_range_filter", "GreaterThanOrEqual(p_size,13)", "p_partkey:bigint,p_name:string,p_size:int"),
        ("name_lookup", "EqualTo(s_suppkey,5)", "s_suppkey:bigint,s_name:string"),
        ("string_filter", "GreaterThan(l_quantity,30.0)", "l_orderkey:bigint,l_linenumber:int,l_quantity:double"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, read):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert pushed in text
    assert f"ReadSchema: struct<{read}>" in text


def test_one_scan_for_both_extremes(spark):
    assert plan(QUERIES["min_max_by_key"](spark, FOLDER)).count("FileScan") == 1
