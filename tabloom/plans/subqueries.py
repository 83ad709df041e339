"""Subqueries, common table expressions and recursion."""

from pyspark.sql import functions as F

from tabloom.functions.amounts import sum_units
from tabloom.operators import recursion as R
from tabloom.operators.growth import add_growth
from tabloom.plans.registry import LINE_SCALE, Section, cents, line_total, line_units, mean, month_of, total

section = Section()
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
AVERAGE = f"(SELECT CAST(SUM({PRICE}) AS DOUBLE) / COUNT(*) FROM orders)"
LINE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@section.query("subq_scalar_select", f"SELECT o_orderkey, o_totalprice - {AVERAGE} AS above_average FROM orders")
def subq_scalar_select(t):
    average = t.orders.agg(mean("o_totalprice")).scalar()
    return t.orders.select("o_orderkey", (F.col("o_totalprice") - average).alias("above_average"))


@section.query(
    "subq_scalar_where",
    """SELECT p_partkey, p_retailprice FROM part WHERE CAST(p_retailprice AS DECIMAL(18,2)) * 1000 >
       (SELECT CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) * 1000 AS DOUBLE) / COUNT(*) FROM part WHERE p_retailprice > 0)""",
)
def subq_scalar_where(t):
    average = t.part.where("p_retailprice > 0").agg((F.sum(cents("p_retailprice") * 1000).cast("double")) / F.count(F.lit(1)))
    return t.part.where((cents("p_retailprice") * 1000).cast("double") > average.scalar()).select(
        "p_partkey", "p_retailprice"
    )


@section.query(
    "subq_corr_count",
    """SELECT c_custkey, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS n_large
       FROM customer""",
)
def subq_corr_count(t):
    return t.sql(
        """SELECT c_custkey, (SELECT COUNT(*) FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS n_large
           FROM {customer}""",
        "orders", "customer",
    )


@section.query("subq_corr_max", "SELECT o_custkey, MAX(o_orderdate) AS latest FROM orders GROUP BY 1")
def subq_corr_max(t):
    return t.sql(
        """SELECT o.o_custkey, (SELECT MAX(o2.o_orderdate) FROM {orders} o2 WHERE o2.o_custkey = o.o_custkey) AS latest
           FROM (SELECT DISTINCT o_custkey FROM {orders}) o""",
        "orders",
    )


@section.query(
    "subq_corr_sum",
    f"""SELECT p_partkey, p_name, (SELECT CAST(SUM({LINE}) AS DOUBLE) FROM lineitem
               WHERE l_partkey = p_partkey AND l_quantity >= 45) AS total_sold FROM part""",
)
def subq_corr_sum(t):
    """Keeps parts that were never sold, unlike the join form (agg_after_join)."""
    sold = (
        t.lineitem.where("l_quantity >= 45")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(line_total().cast("double").alias("total_sold"))
    )
    return t.part.join(sold, "p_partkey", "left").select("p_partkey", "p_name", "total_sold")


@section.query(
    "subq_derived_table",
    f"""SELECT x.o_custkey, x.spent FROM (SELECT o_custkey, CAST(SUM({PRICE}) AS DOUBLE) AS spent FROM orders GROUP BY 1) x
        WHERE x.spent > 3000000""",
)
def subq_derived_table(t):
    spent = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("spent"))
    return spent.where("spent > 3000000")


@section.query(
    "cte_simple",
    f"""WITH s AS (SELECT o_custkey, COUNT(*) AS n_orders, CAST(SUM({PRICE}) AS DOUBLE) AS spent FROM orders GROUP BY 1)
        SELECT c_name, n_orders, spent FROM s JOIN customer ON c_custkey = o_custkey WHERE n_orders > 12""",
)
def cte_simple(t):
    summary = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), total("o_totalprice").alias("spent")
    )
    return (
        summary.where("n_orders > 12")
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_name", "n_orders", "spent")
    )


FLAT = f"""SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, l_partkey, {LINE} AS amount
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey"""
BY_MONTH = f"SELECT c_nationkey, order_month, SUM(amount) AS revenue FROM ({FLAT}) GROUP BY 1, 2"


def flat_lines(t):
    return (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_nationkey", month_of("o_orderdate").alias("order_month"), "l_partkey", line_units().alias("amount"))
    )


def by_month(lines):
    return lines.groupBy("c_nationkey", "order_month").agg(sum_units("amount", LINE_SCALE).alias("revenue"))


@section.query(
    "cte_steps_flat", f"SELECT c_nationkey, order_month, l_partkey, CAST(amount AS DOUBLE) AS amount FROM ({FLAT})"
)
def cte_steps_flat(t):
    return flat_lines(t).withColumn("amount", F.col("amount") / F.lit(10000.0))


@section.query(
    "cte_steps_month", f"SELECT c_nationkey, order_month, CAST(revenue AS DOUBLE) AS revenue FROM ({BY_MONTH})"
)
def cte_steps_month(t):
    return by_month(flat_lines(t)).withColumn("revenue", F.col("revenue").cast("double"))


@section.query(
    "cte_steps_growth",
    f"""SELECT c_nationkey, order_month, CAST(revenue AS DOUBLE) AS revenue,
               CAST(100.0 * (revenue - prev) / NULLIF(prev, 0) AS DECIMAL(10,1)) AS growth_pct
        FROM (SELECT *, LAG(revenue) OVER (PARTITION BY c_nationkey ORDER BY order_month) AS prev FROM ({BY_MONTH}))""",
)
def cte_steps_growth(t):
    grown = add_growth(by_month(flat_lines(t)), ["c_nationkey"], "order_month", "revenue")
    return grown.select("c_nationkey", "order_month", F.col("revenue").cast("double").alias("revenue"), "growth_pct")


@section.query(
    "cte_reused",
    f"""WITH s AS (SELECT l_partkey, SUM({LINE}) AS sold FROM lineitem GROUP BY 1)
        SELECT p_partkey, p_name, CAST(sold AS DOUBLE) AS sold FROM s JOIN part ON p_partkey = l_partkey
        WHERE sold > (SELECT SUM(sold) / COUNT(*) FROM s)""",
)
def cte_reused(t):
    sold = t.lineitem.groupBy("l_partkey").agg(line_total().alias("sold"))
    average = sold.agg(F.avg("sold")).scalar()
    return (
        sold.where(F.col("sold") > average)
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select("p_partkey", "p_name", F.col("sold").cast("double").alias("sold"))
    )


@section.query(
    "rec_sequence",
    """WITH RECURSIVE m(month_start, last) AS (
         SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS DATE), CAST(MAX(o_orderdate) AS DATE) FROM orders
         UNION ALL SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE), last FROM m WHERE month_start + INTERVAL 1 MONTH <= last)
       SELECT month_start, COUNT(o_orderkey) AS n_urgent
       FROM m LEFT JOIN orders ON date_trunc('month', o_orderdate) = month_start AND o_orderpriority = '1-URGENT'
       GROUP BY 1""",
)
def rec_sequence(t):
    """A calendar of months from the first to the last order, with the urgent orders of each."""
    calendar = t.orders.agg(
        F.sequence(
            F.trunc(F.min("o_orderdate"), "month"), F.to_date(F.max("o_orderdate")), F.expr("INTERVAL 1 MONTH")
        ).alias("months")
    ).select(F.explode("months").alias("month_start"))
    urgent = (
        t.orders.where("o_orderpriority = '1-URGENT'")
        .groupBy(month_of("o_orderdate").alias("month_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return calendar.join(urgent, "month_start", "left").select(
        "month_start", F.coalesce("n", F.lit(0)).alias("n_urgent")
    )


WEEKS = """WITH RECURSIVE w(week_no, last_week) {limit} AS (
             SELECT 0, {weeks} FROM {orders}
             UNION ALL SELECT week_no + 1, last_week FROM w WHERE week_no < last_week)
           SELECT week_no FROM w"""


@section.query(
    "rec_limit",
    "WITH g AS ("
    + WEEKS.format(limit="", orders="orders", weeks="date_diff('day', MIN(o_orderdate), MAX(o_orderdate)) // 7")
    + ") SELECT CAST(week_no AS INTEGER) AS week_no FROM g",
)
def rec_limit(t):
    """Weeks of the order history: deeper than the default limit of 100 levels."""
    return t.spark.sql(
        WEEKS.format(
            limit="MAX RECURSION LEVEL 1000",
            orders="{orders}",
            weeks="CAST(datediff(MAX(o_orderdate), MIN(o_orderdate)) div 7 AS INT)",
        ),
        orders=t.orders,
    )


TREE = """WITH RECURSIVE e AS (SELECT p_partkey, CASE WHEN p_partkey > 0 THEN (p_partkey - 1) // 7 END AS parent FROM part),
          h AS (SELECT p_partkey, parent, 0 AS level, [] :: BIGINT[] AS path FROM e WHERE parent IS NULL
                UNION ALL SELECT e.p_partkey, e.parent, h.level + 1, list_append(h.path, e.p_partkey)
                FROM e JOIN h ON e.parent = h.p_partkey)"""


def part_tree(t, with_path=False):
    edges = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") > 0, F.expr("(p_partkey - 1) div 7")).alias("parent")
    )
    return R.hierarchy(edges, "p_partkey", "parent", with_path=with_path)


@section.query("rec_hierarchy", TREE + " SELECT p_partkey, parent, level FROM h")
def rec_hierarchy(t):
    return part_tree(t)


@section.query(
    "rec_path_functions",
    TREE
    + """ SELECT p_partkey, CAST(len(path) AS INTEGER) AS depth, len(path) = 0 AS is_root,
                 array_to_string(path, '/') AS path_text,
                 CASE WHEN len(path) >= 1 THEN array_to_string(path[1:len(path) - 1], '/') END AS ancestor_text,
                 COALESCE(path[1] = 1, FALSE) AS below_first FROM h""",
)
def rec_path_functions(t):
    path = F.col("path")
    first_child = F.array(F.lit(1).cast("bigint"))
    as_text = lambda p: F.array_join(p.cast("array<string>"), "/")
    return part_tree(t, with_path=True).select(
        "p_partkey",
        R.path_level(path).alias("depth"),
        (F.size(path) == 0).alias("is_root"),
        as_text(path).alias("path_text"),
        as_text(R.path_ancestor(path, 1)).alias("ancestor_text"),
        R.path_is_below(path, first_child).alias("below_first"),
    )
