"""Pairs of forms that must agree."""

from pyspark.sql import Window, functions as F

from tabloom.functions.amounts import sum_amount
from tabloom.operators import joins as J, windows as W
from tabloom.operators.aggregates import salted_sum
from tabloom.operators.profiles import column_histogram
from tabloom.plans import selection, subqueries
from tabloom.functions import predicates as P


def test_rollup_is_grouping_sets(tables, same):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    n = F.count(F.lit(1)).alias("n")
    same(
        tables.orders.rollup(status, priority).agg(n),
        tables.orders.groupingSets([[status, priority], [status], []], status, priority).agg(n),
    )


def test_pivot_is_conditional_sum(tables, same):
    orders = tables.orders.select("o_orderstatus", F.year("o_orderdate").alias("y"), F.col("o_custkey").alias("x"))
    wide = orders.groupBy("o_orderstatus").pivot("y", [1996, 1997]).sum("x")
    same(
        wide,
        orders.groupBy("o_orderstatus").agg(
            *[F.sum(F.when(F.col("y") == y, F.col("x"))).alias(str(y)) for y in (1996, 1997)]
        ),
    )


def test_apply_is_lateral_is_row_number(tables, same):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    applied = J.apply_first(tables.customer, tables.orders, "c_custkey", "o_custkey", order, 3)
    lateral = tables.sql(
        """SELECT * FROM {customer}, LATERAL (SELECT * FROM {orders} WHERE o_custkey = c_custkey
           ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)""",
        "customer", "orders",
    )
    same(applied, lateral)
    outer = J.apply_first(tables.customer, tables.orders.where("o_totalprice > 490000"), "c_custkey", "o_custkey", order, 1, True)
    assert outer.select("c_custkey").distinct().count() == tables.customer.count()


def test_three_anti_joins(tables, same):
    lines = tables.lineitem
    by_join = tables.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").where("l_orderkey IS NULL")
    by_exists = tables.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    by_except = tables.orders.select("o_orderkey").subtract(lines.select("l_orderkey"))
    same(by_join.select("o_orderkey"), by_exists.select("o_orderkey"))
    same(by_exists.select("o_orderkey"), by_except)
    same(by_except, J.not_in(tables.orders, "o_orderkey", lines, "l_orderkey").select("o_orderkey"))


def test_range_filters_are_function_filters(tables, same):
    orders = tables.orders
    same(orders.where(P.in_year("o_orderdate", 1997)), orders.where(F.year("o_orderdate") == 1997))
    for month in ("1997-11", "1997-12"):
        same(
            orders.where(P.in_month("o_orderdate", month)),
            orders.where(F.date_format("o_orderdate", "yyyy-MM") == month),
        )


def test_correlated_max_is_grouped_max(tables, same):
    same(subqueries.subq_corr_max(tables), tables.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest")))


def test_collation_is_case_insensitive_like(tables, same):
    same(
        selection.filter_like_ci(tables),
        tables.part.where(F.expr("p_type COLLATE UTF8_LCASE LIKE '%rom%'")).select("p_partkey", "p_type"),
    )


def test_group_aggregates_are_a_window(tables, same):
    orders = tables.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("g"), "o_custkey")
    found = W.with_group_aggregates(orders, ["g"], [F.sum("o_custkey").alias("s"), F.count(F.lit(1)).alias("n")])
    window = Window.partitionBy("g")
    same(found, orders.select("*", F.sum("o_custkey").over(window).alias("s"), F.count(F.lit(1)).over(window).alias("n")))


def test_latest_row_is_row_number_one(tables, same):
    window = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    plain = tables.events.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")
    same(W.latest_per_key(tables.events, ["user_id"], ["ts", "event_id"]), plain)


def test_salted_sum_is_a_sum(tables, same):
    measures = {"q": F.col("l_linenumber"), "n": F.lit(1)}
    plain = tables.lineitem.groupBy("l_returnflag").agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    same(salted_sum(tables.lineitem, "l_returnflag", measures), plain)


def test_sum_of_units_is_a_decimal_sum(values):
    df = values("g int, x double", (1, 0.1), (1, 0.2), (1, -5.35), (2, 123456789.99), (2, None), (3, None))
    rows = df.groupBy("g").agg(
        sum_amount("x").cast("double").alias("s"), F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("d")
    ).collect()
    assert len(rows) == 3 and all(r.s == r.d for r in rows)


def test_sum_of_units_beyond_64_bits(spark):
    df = spark.range(4).select(F.lit(9_000_000_000_000_000.0).alias("x"))
    assert int(df.agg(sum_amount("x", 2)).first()[0]) == 36_000_000_000_000_000


def test_histogram_covers_all_rows(tables):
    rows = column_histogram(tables.lineitem, "l_partkey", steps=20).collect()
    assert len(rows) <= 20
    assert sum(r.eq_rows + r.range_rows for r in rows) == tables.lineitem.count()
    assert sum(r.distinct_range_rows + 1 for r in rows) == tables.lineitem.select("l_partkey").distinct().count()
