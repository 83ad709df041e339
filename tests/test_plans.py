"""What Spark makes of the plans: pushed filters, read columns, strategies."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL
from tabloom.operators import joins as J
from tabloom.plans import aggregates, routines, selection, windows
from tabloom.session import shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "query,pushed",
    [
        (selection.filter_half_open_range, ["GreaterThanOrEqual(ts", "LessThan(ts"]),
        (selection.filter_year_sargable, ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"]),
        (selection.filter_month_sargable, ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"]),
        (selection.filter_in_list, ["In(o_orderpriority"]),
        (selection.filter_like_prefix, ["StringStartsWith(p_name"]),
        (selection.filter_compare, ["GreaterThanOrEqual(l_quantity", "Not(EqualTo(l_linestatus"]),
        (aggregates.agg_filtered_join, ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"]),
        (routines.tvf_category, ["EqualTo(p_type"]),
        (routines.tvf_date_range, ["GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate"]),
    ],
)
def test_filters_reach_the_scan(spark, tables, query, pushed):
    df = query(tables)
    df.collect()
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    filters = " ".join(line for line in text.splitlines() if line.startswith("PushedFilters"))
    for wanted in pushed:
        assert wanted in filters


def test_only_needed_columns_are_read(tables):
    text = plan(windows.case_study_sales(tables))
    assert "l_comment" not in text and "l_tax" not in text and "o_totalprice" not in text


def test_group_limit_runs_before_the_shuffle(tables):
    for query in (windows.win_topn_per_group, windows.longest_streak, windows.case_study_sales):
        assert "WindowGroupLimit" in plan(query(tables))


def test_product_table_is_computed_once(tables):
    df = windows.case_study_sales(tables)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_sql_functions_are_expressions(tables):
    text = plan(routines.udf_scalar(tables))
    assert "Python" not in text and "whole_years" not in text


@pytest.mark.parametrize(
    "strategy,operator",
    [("broadcast", "BroadcastHashJoin"), ("hash", "ShuffledHashJoin"), ("merge", "SortMergeJoin")],
)
def test_join_strategies(tables, strategy, operator):
    joined = J.join_with(tables.orders, tables.customer, F.col("o_custkey") == F.col("c_custkey"), strategy)
    assert operator in plan(joined)


def test_no_query_runs_rows_through_python(spark):
    """Python is left to the one stateful stream, which ends before its result is read."""
    skipped = {n for n in contract.queries() if n.startswith("stream_")}
    for name, query in contract.queries().items():
        if name not in skipped:
            assert "EvalPython" not in plan(query(spark, SMALL)), name


def test_not_in_is_an_ordinary_anti_join(tables):
    text = plan(J.not_in(tables.orders, "o_orderkey", tables.lineitem, "l_orderkey"))
    assert "LeftAnti" in text and "NestedLoop" not in text


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
