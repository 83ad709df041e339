"""Grouping, subtotals, pivots and conditional aggregates."""

from pyspark.sql import functions as F

from tabloom.functions.amounts import sum_amount, sum_units, units
from tabloom.functions.predicates import in_month, in_year
from tabloom.operators import aggregates as A
from tabloom.plans.registry import Section, line_total, mean, month_of, total

section = Section()
SUM_PRICE = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"
AVG_PRICE = f"{SUM_PRICE} / COUNT(o_totalprice)"
YEAR = "CAST(year(o_orderdate) AS INTEGER)"


def count_rows():
    return F.count(F.lit(1))


@section.query("agg_count_star", "SELECT COUNT(*) AS n_rows FROM lineitem")
def agg_count_star(t):
    return t.lineitem.agg(count_rows().alias("n_rows"))


@section.query(
    "agg_counts_null_distinct",
    """SELECT COUNT(*) AS n_rows, COUNT(NULLIF(p_type, 'ECONOMY')) AS n_colors,
              COUNT(DISTINCT NULLIF(p_type, 'ECONOMY')) AS n_distinct FROM part""",
)
def agg_counts_null_distinct(t):
    parts = t.part.select(F.nullif("p_type", F.lit("ECONOMY")).alias("color"))
    return parts.agg(
        count_rows().alias("n_rows"),
        F.count("color").alias("n_colors"),
        F.count_distinct("color").alias("n_distinct"),
    )


@section.query(
    "agg_basic_by_year",
    f"""SELECT {YEAR} AS order_year, COUNT(*) AS n, {SUM_PRICE} AS revenue, {AVG_PRICE} AS average,
               MIN(o_totalprice) AS smallest, MAX(o_totalprice) AS largest FROM orders GROUP BY 1""",
)
def agg_basic_by_year(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        count_rows().alias("n"),
        total("o_totalprice").alias("revenue"),
        mean("o_totalprice").alias("average"),
        F.min("o_totalprice").alias("smallest"),
        F.max("o_totalprice").alias("largest"),
    )


@section.query(
    "agg_multi_key",
    f"""SELECT {YEAR} AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month, COUNT(*) AS n,
               {SUM_PRICE} AS revenue FROM orders GROUP BY 1, 2""",
)
def agg_multi_key(t):
    return t.orders.groupBy(
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month")
    ).agg(count_rows().alias("n"), total("o_totalprice").alias("revenue"))


@section.query(
    "agg_having", "SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1 HAVING COUNT(*) >= 15"
)
def agg_having(t):
    return t.orders.groupBy("o_custkey").agg(count_rows().alias("n_orders")).where("n_orders >= 15")


@section.query(
    "agg_having_multi",
    f"""SELECT o_custkey, COUNT(*) AS n_orders, {AVG_PRICE} AS average FROM orders GROUP BY 1
        HAVING COUNT(*) > 10 AND {AVG_PRICE} > 260000""",
)
def agg_having_multi(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(count_rows().alias("n_orders"), mean("o_totalprice").alias("average"))
        .where("n_orders > 10 AND average > 260000")
    )


@section.query(
    "agg_grouping_sets",
    f"""SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, {SUM_PRICE} AS revenue FROM orders
        GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
)
def agg_grouping_sets(t):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.groupingSets([[status, priority], [status], []], status, priority).agg(
        count_rows().alias("n"), total("o_totalprice").alias("revenue")
    )


@section.query(
    "agg_rollup",
    f"""SELECT o_orderstatus, {YEAR} AS order_year, {SUM_PRICE} AS revenue FROM orders
        GROUP BY ROLLUP (o_orderstatus, {YEAR})""",
)
def agg_rollup(t):
    return t.orders.rollup("o_orderstatus", F.year("o_orderdate").alias("order_year")).agg(
        total("o_totalprice").alias("revenue")
    )


@section.query(
    "agg_rollup_single",
    f"""SELECT o_orderpriority, COUNT(*) AS n, {SUM_PRICE} AS revenue FROM orders
        WHERE year(o_orderdate) = 1999 GROUP BY ROLLUP (o_orderpriority)""",
)
def agg_rollup_single(t):
    return (
        t.orders.where(in_year("o_orderdate", 1999))
        .rollup("o_orderpriority")
        .agg(count_rows().alias("n"), total("o_totalprice").alias("revenue"))
    )


@section.query(
    "agg_cube",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
)
def agg_cube(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(count_rows().alias("n"))


@section.query(
    "agg_grouping_flag",
    """SELECT CASE WHEN GROUPING(color) = 1 THEN 'all colors' ELSE color END AS color_label,
              CAST(GROUPING(color) AS INTEGER) AS is_total, COUNT(*) AS n
       FROM (SELECT NULLIF(p_type, 'ECONOMY') AS color FROM part) GROUP BY ROLLUP (color)""",
)
def agg_grouping_flag(t):
    """The marker tells the grand total from the group whose key is NULL."""
    parts = t.part.select(F.nullif("p_type", F.lit("ECONOMY")).alias("color"))
    grouped = parts.rollup("color").agg(F.grouping("color").cast("int").alias("is_total"), count_rows().alias("n"))
    label = F.when(F.col("is_total") == 1, "all colors").otherwise(F.col("color"))
    return grouped.select(label.alias("color_label"), "is_total", "n")


LINE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@section.query(
    "agg_after_join",
    f"""SELECT p_name, CAST(SUM({LINE}) AS DOUBLE) AS total_sold FROM part JOIN lineitem ON l_partkey = p_partkey
        GROUP BY p_name""",
)
def agg_after_join(t):
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_name")
        .agg(line_total().cast("double").alias("total_sold"))
    )


@section.query(
    "agg_topn_groups",
    f"SELECT o_custkey, {SUM_PRICE} AS spent FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def agg_topn_groups(t):
    spent = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("spent"))
    return spent.orderBy(F.col("spent").desc(), "o_custkey").limit(3)


@section.query(
    "agg_of_agg",
    """WITH m AS (SELECT c_nationkey, date_trunc('month', o_orderdate) AS m,
                         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
                  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
       SELECT n_name, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS avg_monthly FROM m
       JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
)
def agg_of_agg(t):
    monthly = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey", month_of("o_orderdate").alias("m"))
        .agg(sum_amount("o_totalprice").alias("revenue"))
    )
    return (
        monthly.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .groupBy("n_name")
        .agg((F.sum("revenue").cast("double") / count_rows()).alias("avg_monthly"))
    )


YEARS = (1996, 1997, 1998, 2002)


def _priced_by_year(t):
    return t.orders.select("o_orderstatus", F.year("o_orderdate").alias("y"), units("o_totalprice").alias("price"))


@section.query(
    "agg_conditional_sum",
    "SELECT o_orderstatus, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN year(o_orderdate) = {y} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS y{y}"
        for y in YEARS
    )
    + ", COUNT(*) AS n_orders FROM orders GROUP BY 1",
)
def agg_conditional_sum(t):
    per_year = [sum_units(F.when(F.col("y") == y, F.col("price"))).cast("double").alias(f"y{y}") for y in YEARS]
    return _priced_by_year(t).groupBy("o_orderstatus").agg(*per_year, count_rows().alias("n_orders"))


@section.query(
    "agg_conditional_count",
    "SELECT o_orderpriority, "
    + ", ".join(f"COUNT(CASE WHEN year(o_orderdate) = {y} THEN 1 END) AS n{y}" for y in YEARS)
    + ", COUNT(*) AS n_orders FROM orders GROUP BY 1",
)
def agg_conditional_count(t):
    y = F.year("o_orderdate")
    counts = [F.count(F.when(y == year, 1)).alias(f"n{year}") for year in YEARS]
    return t.orders.groupBy("o_orderpriority").agg(*counts, count_rows().alias("n_orders"))


@section.query(
    "pivot_sum",
    "SELECT o_orderstatus, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN year(o_orderdate) = {y} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS \"{y}\""
        for y in YEARS
    )
    + " FROM orders GROUP BY 1",
)
def pivot_sum(t):
    wide = _priced_by_year(t).groupBy("o_orderstatus").pivot("y", list(YEARS)).agg(sum_units("price"))
    return wide.select("o_orderstatus", *[F.col(str(y)).cast("double").alias(str(y)) for y in YEARS])


MEASURES = "SELECT p_partkey, p_retailprice AS price, CAST(p_size AS DOUBLE) AS size, CAST(NULLIF(p_size, 7) AS DOUBLE) AS odd_size FROM part"


def _part_measures(t):
    size = F.col("p_size").cast("double")
    return t.part.select(
        "p_partkey",
        F.col("p_retailprice").alias("price"),
        size.alias("size"),
        F.nullif(size, F.lit(7.0)).alias("odd_size"),
    )


@section.query(
    "unpivot_drop_nulls",
    f"SELECT p_partkey, measure, value FROM ({MEASURES}) UNPIVOT (value FOR measure IN (price, size, odd_size))",
)
def unpivot_drop_nulls(t):
    return A.unpivot(_part_measures(t), ["p_partkey"], ["price", "size", "odd_size"])


@section.query(
    "unpivot_keep_nulls",
    f"""SELECT p_partkey, measure, value FROM ({MEASURES})
        UNPIVOT INCLUDE NULLS (value FOR measure IN (price, size, odd_size))""",
)
def unpivot_keep_nulls(t):
    return A.unpivot(_part_measures(t), ["p_partkey"], ["price", "size", "odd_size"], include_nulls=True)


@section.query(
    "agg_string_agg", "SELECT p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names FROM part GROUP BY 1"
)
def agg_string_agg(t):
    return A.text_list(t.part, ["p_brand"], "p_name", "names")


@section.query(
    "agg_string_agg_conditional",
    """SELECT p_brand, string_agg(DISTINCT CASE WHEN p_size > 45 THEN p_name END, ', '
              ORDER BY CASE WHEN p_size > 45 THEN p_name END) AS large_names FROM part GROUP BY 1""",
)
def agg_string_agg_conditional(t):
    brands = t.part.select("p_brand").distinct()
    large = A.text_list(t.part.where("p_size > 45"), ["p_brand"], "p_name", "large_names")
    return brands.join(large, "p_brand", "left")


@section.query(
    "agg_null_skip",
    """SELECT p_brand, COUNT(*) AS n_rows, COUNT(size) AS n_sizes, CAST(SUM(size) AS BIGINT) AS sum_size,
              CAST(SUM(size) AS DOUBLE) / COUNT(size) AS avg_size, MIN(size) AS min_size, MAX(size) AS max_size
       FROM (SELECT p_brand, NULLIF(p_size, 7) AS size FROM part) GROUP BY 1""",
)
def agg_null_skip(t):
    sized = t.part.select("p_brand", F.nullif("p_size", F.lit(7)).alias("size"))
    return sized.groupBy("p_brand").agg(
        count_rows().alias("n_rows"),
        F.count("size").alias("n_sizes"),
        F.sum("size").alias("sum_size"),
        F.avg("size").alias("avg_size"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
    )


@section.query(
    "agg_avg_int_trunc",
    "SELECT p_type, CAST(SUM(p_size) AS BIGINT) // COUNT(p_size) AS avg_size FROM part GROUP BY 1",
)
def agg_avg_int_trunc(t):
    return t.part.groupBy("p_type").agg(A.avg_int("p_size").alias("avg_size"))


@section.query(
    "agg_avg_decimal",
    """SELECT p_type, CAST(CAST(SUM(p_size) AS DOUBLE) / COUNT(p_size) AS DECIMAL(14,6)) AS avg_size
       FROM part GROUP BY 1""",
)
def agg_avg_decimal(t):
    return t.part.groupBy("p_type").agg(F.avg(F.col("p_size").cast("decimal(10,2)")).alias("avg_size"))


@section.query(
    "agg_safe_ratio",
    """SELECT o_custkey, COUNT(*) // NULLIF(COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0) AS orders_per_finished,
              CAST(COUNT(*) AS DOUBLE) / NULLIF(COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0) AS exact_ratio
       FROM orders GROUP BY 1""",
)
def agg_safe_ratio(t):
    finished = F.count(F.when(F.col("o_orderstatus") == "F", 1))
    return t.orders.groupBy("o_custkey").agg(
        A.safe_int_ratio(count_rows(), finished).alias("orders_per_finished"),
        A.safe_ratio(count_rows().cast("double"), finished).alias("exact_ratio"),
    )


@section.query(
    "agg_dup_check",
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem""",
)
def agg_dup_check(t):
    return A.duplicate_check(t.lineitem, ["l_orderkey", "l_linenumber"])


@section.query(
    "agg_filtered_join",
    f"""SELECT o_orderkey, CAST(SUM({LINE}) AS DOUBLE) AS order_total FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1997-08-01' GROUP BY 1""",
)
def agg_filtered_join(t):
    return (
        t.orders.where(in_month("o_orderdate", "1997-07"))
        .join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderkey")
        .agg(line_total().cast("double").alias("order_total"))
    )
