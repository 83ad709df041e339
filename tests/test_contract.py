"""Every query against its SQL counterpart on the smallest tables."""

import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import ROOT, SMALL
from tabloom.sources.tables import TABLE_NAMES
from tools.check import compare

# the optional training-data queries have tests of their own
OPTIONAL = {"pipeline", *(contract.llm_queries.QUERIES if contract.llm_queries else ())}
PLANS = {name: plan for name, plan in contract.queries().items() if name not in OPTIONAL}
CHECKS = {name: sql for name, sql in contract.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, duck, name):
    verdict, rows, _, note = compare(spark, duck, name, PLANS[name], CHECKS.get(name), SMALL)
    assert verdict in ("ok", "rows-only"), note
    assert rows >= 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(PLANS)
    assert sorted(set(PLANS) - set(CHECKS)) == [
        "compaction_report", "file_layout_report", "fn_now", "fn_random", "limit_any",
    ]


def test_listing_queries_needs_no_session():
    code = "import __spark_entry__ as c; assert c.queries() and c.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "n_name", "month", "revenue", "growth_pct", "p_name", "product_revenue", "contribution_pct",
    ]
    assert result.count() > 0
