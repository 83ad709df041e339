"""Views, SQL functions, table functions and parameterised procedures."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import routines as R
from tabloom.plans.registry import Section, line_total, total

section = Section()
SPENT = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"
LINE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@section.query(
    "view_customer_summary",
    f"""SELECT c_custkey, c_name, COUNT(*) AS n_orders, {SPENT} AS spent, MAX(o_orderdate) AS last_order
        FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def view_customer_summary(t):
    summary = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_custkey", "c_name")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            total("o_totalprice").alias("spent"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    summary.createOrReplaceTempView("customer_summary")
    return t.spark.table("customer_summary")


@section.query(
    "view_top_products",
    f"""SELECT p_partkey, p_name, CAST(SUM({LINE}) AS DOUBLE) AS sold FROM lineitem JOIN part ON p_partkey = l_partkey
        GROUP BY 1, 2 ORDER BY sold DESC, p_partkey LIMIT 20""",
)
def view_top_products(t):
    sold = t.lineitem.groupBy("l_partkey").agg(line_total().cast("double").alias("sold"))
    top = sold.orderBy(F.col("sold").desc(), "l_partkey").limit(20)
    named = t.part.join(F.broadcast(top), F.col("l_partkey") == F.col("p_partkey"))
    named.select("p_partkey", "p_name", "sold").createOrReplaceTempView("top_products")
    return t.spark.table("top_products").orderBy(F.col("sold").desc(), "p_partkey")


AGE = """year(as_of) - year(since) - CASE
         WHEN struct(month(as_of), dayofmonth(as_of)) < struct(month(since), dayofmonth(since)) THEN 1 ELSE 0 END"""


@section.query(
    "udf_scalar",
    """SELECT o_orderkey, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS age FROM orders""",
)
def udf_scalar(t):
    R.create_function(t.spark, "whole_years(since DATE, as_of DATE)", "INT", AGE)
    return t.sql(
        "SELECT o_orderkey, whole_years(CAST(o_orderdate AS DATE), DATE '2001-12-31') AS age FROM {orders}", "orders"
    )


@section.query(
    "udf_on_topk",
    """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS shown FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
)
def udf_on_topk(t):
    R.create_function(t.spark, "as_dollars(amount DECIMAL(18,2))", "STRING", "concat('$', format_number(amount, 2))")
    return t.sql(
        """SELECT o_orderkey, as_dollars(CAST(o_totalprice AS DECIMAL(18,2))) AS shown
           FROM (SELECT * FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)""",
        "orders",
    )


@section.query(
    "tvf_category", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'PROMO'"
)
def tvf_category(t):
    R.create_function(
        t.spark,
        "parts_of_type(wanted STRING)",
        "TABLE (p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE)",
        f"SELECT p_partkey, p_name, p_retailprice FROM parquet.`{t.file_of('part')}` WHERE p_type = wanted",
    )
    return t.spark.sql("SELECT * FROM parts_of_type('PROMO')")


@section.query(
    "tvf_date_range",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-05-16'""",
)
def tvf_date_range(t):
    R.create_function(
        t.spark,
        "orders_between(first_day DATE, last_day DATE)",
        "TABLE (o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE)",
        f"""SELECT o_orderkey, o_orderdate, o_totalprice FROM parquet.`{t.file_of('orders')}`
            WHERE o_orderdate >= CAST(first_day AS TIMESTAMP_NTZ)
              AND o_orderdate < CAST(date_add(last_day, 1) AS TIMESTAMP_NTZ)""",
    )
    return t.spark.sql("SELECT * FROM orders_between(DATE '1998-02-01', DATE '1998-05-15')")


def customer_tiers(orders, high=3_500_000, mid=2_000_000):
    """A table function of several steps: totals, then tiers, then counts per tier."""
    spent = orders.groupBy("o_custkey").agg(total("o_totalprice").alias("spent"))
    tier = F.when(F.col("spent") > high, "high").when(F.col("spent") > mid, "mid").otherwise("low")
    return spent.withColumn("tier", tier).groupBy("tier").agg(
        F.count(F.lit(1)).alias("n_customers"), total("spent").alias("spent")
    )


@section.query(
    "tvf_multi_step",
    f"""WITH s AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY 1)
        SELECT CASE WHEN spent > 3500000 THEN 'high' WHEN spent > 2000000 THEN 'mid' ELSE 'low' END AS tier,
               COUNT(*) AS n_customers, CAST(SUM(spent) AS DOUBLE) AS spent FROM s GROUP BY 1""",
)
def tvf_multi_step(t):
    return customer_tiers(t.orders)


def orders_by_customer(t, customer_id=None, least=0.0):
    """Orders of one customer, or of all, from an optional smallest price on."""
    orders = t.orders.where(F.col("o_totalprice") >= least)
    if customer_id is not None:
        orders = orders.where(F.col("o_custkey") == customer_id)
    return orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@section.query(
    "proc_orders_by_customer",
    """SELECT 'one' AS call, o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_custkey = 42
       UNION ALL SELECT 'all', o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice >= 300000""",
)
def proc_orders_by_customer(t):
    one = orders_by_customer(t, 42).select(F.lit("one").alias("call"), "*")
    return one.unionByName(orders_by_customer(t, least=300000.0).select(F.lit("all").alias("call"), "*"))


@section.query(
    "proc_output_scalar",
    """SELECT o_orderstatus, COUNT(*) AS n, (SELECT COUNT(*) FROM orders) AS n_all FROM orders GROUP BY 1""",
)
def proc_output_scalar(t):
    R.set_variable(t.spark, "n_all_orders", "BIGINT", "SELECT COUNT(*) FROM {orders}", orders=t.orders)
    return t.sql("SELECT o_orderstatus, COUNT(*) AS n, n_all_orders AS n_all FROM {orders} GROUP BY 1", "orders")


@section.query(
    "safe_divide_report",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio,
              CASE WHEN l_discount = 0 THEN 'DIVIDE_BY_ZERO' END AS error FROM lineitem""",
)
def safe_divide_report(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", *R.safe_divide(F.col("l_tax"), F.col("l_discount"), "ratio", "error")
    )


@section.query(
    "raise_custom_error",
    """SELECT 'balance' AS rule, 50001 AS error_number, 'Insufficient balance' AS error_message, COUNT(*) AS n_rows
       FROM customer HAVING COUNT(CASE WHEN c_acctbal < 0 THEN 1 END) > 0
       UNION ALL SELECT 'size', CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), COUNT(*) FROM part""",
)
def raise_custom_error(t):
    """A broken condition raises an error with a number; the caller reports it and goes on."""
    checks = {
        "balance": (t.customer, F.col("c_acctbal") >= 0, 50001, "Insufficient balance"),
        "size": (t.part, F.col("p_size") >= 0, 50002, "Negative size"),
    }
    reports = []
    for rule, (df, condition, number, message) in checks.items():
        raised = None
        try:
            R.require(df, condition, number, message)
        except R.DataError as error:
            raised = error
        reports.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(rule).alias("rule"),
                F.lit(raised.number if raised else None).cast("int").alias("error_number"),
                F.lit(raised.message if raised else None).cast("string").alias("error_message"),
                "n_rows",
            )
        )
    return reduce(DataFrame.unionByName, reports)
