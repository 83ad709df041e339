"""Scans, table creation and storage reports."""

from pyspark.sql import functions as F

from tabloom.operators.ordering import number_rows
from tabloom.operators.profiles import profile_columns
from tabloom.plans.registry import Section, cents, mean, month_of, total
from tabloom.sources import tables

section = Section()


@section.query("scan_all", "SELECT * FROM lineitem")
def scan_all(t):
    return t.lineitem


@section.query(
    "register_tables",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT CAST(COUNT(*) AS INTEGER) FROM (DESCRIBE {n})) AS n_columns,"
        f" (SELECT COUNT(*) FROM {n}) AS n_rows"
        for n in tables.TABLE_NAMES
    ),
)
def register_tables(t):
    return tables.register_tables(t.spark, t.path)


@section.query(
    "select_into",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def select_into(t):
    finished = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    return tables.select_into(finished)


@section.query(
    "inline_values",
    """SELECT v.label, COUNT(*) AS n_orders
       FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) v(code, label)
         ON o_orderstatus = v.code GROUP BY v.label""",
)
def inline_values(t):
    labels = t.spark.sql(
        "SELECT * FROM VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending') AS v(code, label)"
    )
    return (
        t.orders.join(labels, F.col("o_orderstatus") == F.col("code"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@section.query(
    "inflate_rows",
    "SELECT event_id, user_id, CAST(copy_no AS INTEGER) AS copy_no FROM events CROSS JOIN range(1, 5) m(copy_no)",
)
def inflate_rows(t):
    return tables.inflate(t.events.select("event_id", "user_id"), 4)


@section.query(
    "generate_ids",
    "SELECT c_custkey, 10 * ROW_NUMBER() OVER (ORDER BY c_custkey) AS generated_id FROM customer",
)
def generate_ids(t):
    numbered = number_rows(t.customer.select("c_custkey"), ["c_custkey"])
    return numbered.select("c_custkey", (F.col("rn") * 10).alias("generated_id"))


@section.query(
    "row_provenance",
    """SELECT o_orderkey, 'orders.parquet' AS file_name, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS row_index
       FROM orders""",
)
def row_provenance(t):
    """The test table is one file in order of its key, so the position can be checked."""
    return tables.row_provenance(t.orders).select("o_orderkey", "file_name", "row_index")


@section.query("file_layout_report")
def file_layout_report(t):
    return tables.file_layout(t.spark, t.file_of("lineitem"))


@section.query("file_layout_holds", "SELECT COUNT(*) AS n_rows, TRUE AS sizes_known FROM lineitem")
def file_layout_holds(t):
    """The rows of the files are the rows of the table, and every file has a size."""
    layout = tables.file_layout(t.spark, t.file_of("lineitem"))
    return layout.agg(F.sum("n_rows").alias("n_rows"), (F.min("file_size") > 0).alias("sizes_known"))


@section.query(
    "temp_result_reuse",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
                         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
                  FROM orders GROUP BY 1)
       SELECT order_month, CAST(revenue AS DOUBLE) AS revenue FROM m
       WHERE revenue > (SELECT CAST(SUM(revenue) AS DOUBLE) / COUNT(*) FROM m)""",
)
def temp_result_reuse(t):
    monthly = tables.select_into(
        t.orders.groupBy(month_of("o_orderdate").alias("order_month")).agg(
            total("o_totalprice").alias("revenue")
        )
    )
    average = monthly.agg(mean("revenue"))
    return monthly.where(F.col("revenue") > average.scalar())


@section.query(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{dt}' AS data_type, COUNT(*) AS n_rows,"
        f" COUNT(*) - COUNT({e}) AS n_nulls, COUNT(DISTINCT {e}) AS n_distinct,"
        f" CAST(MIN({e}) AS VARCHAR) AS min_value, CAST(MAX({e}) AS VARCHAR) AS max_value FROM orders"
        for c, dt, e in (
            ("o_orderkey", "bigint", "o_orderkey"),
            ("o_custkey", "bigint", "o_custkey"),
            ("o_orderstatus", "string", "o_orderstatus"),
            ("o_totalprice", "decimal(18,2)", "CAST(o_totalprice AS DECIMAL(18,2))"),
            ("o_orderdate", "date", "CAST(o_orderdate AS DATE)"),
            ("o_orderpriority", "string", "o_orderpriority"),
        )
    ),
)
def profile(t):
    return profile_columns(
        t.orders.withColumn("o_totalprice", cents("o_totalprice")).withColumn(
            "o_orderdate", F.to_date("o_orderdate")
        )
    )
