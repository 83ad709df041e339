"""Joins, semi and anti joins, and per-row apply."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.predicates import in_month, in_year
from tabloom.operators import joins as J
from tabloom.plans.registry import Section, total

section = Section()


@section.query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice"
    )


def _march_orders(t):
    return t.orders.where(in_month("o_orderdate", "1997-03"))


MARCH = "SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'"


@section.query(
    "join_left", f"SELECT c_custkey, o_orderkey FROM customer LEFT JOIN ({MARCH}) ON o_custkey = c_custkey"
)
def join_left(t):
    return t.customer.join(_march_orders(t), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "o_orderkey"
    )


@section.query(
    "join_right", f"SELECT o_orderkey, c_custkey FROM ({MARCH}) RIGHT JOIN customer ON o_custkey = c_custkey"
)
def join_right(t):
    return _march_orders(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right").select(
        "o_orderkey", "c_custkey"
    )


@section.query(
    "join_full",
    f"""SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_acctbal > 0)
        FULL JOIN ({MARCH}) ON o_custkey = c_custkey""",
)
def join_full(t):
    funded = t.customer.where("c_acctbal > 0")
    return funded.join(_march_orders(t), F.col("o_custkey") == F.col("c_custkey"), "full").select(
        "c_custkey", "o_orderkey"
    )


@section.query(
    "join_cross",
    """WITH s AS (SELECT DISTINCT c_mktsegment FROM customer),
            n AS (SELECT c_mktsegment, n_regionkey, COUNT(*) AS n_customers
                  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
       SELECT r_name, s.c_mktsegment, COALESCE(n_customers, 0) AS n_customers
       FROM region CROSS JOIN s LEFT JOIN n ON n.c_mktsegment = s.c_mktsegment AND n_regionkey = r_regionkey""",
)
def join_cross(t):
    """Every region with every segment, including the pairs without a customer."""
    segments = t.customer.select("c_mktsegment").distinct()
    counts = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("c_mktsegment", F.col("n_regionkey").alias("r_regionkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        segments.crossJoin(t.region)
        .join(counts, ["c_mktsegment", "r_regionkey"], "left")
        .select("r_name", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_customers"))
    )


@section.query(
    "join_self",
    """SELECT e.p_partkey, e.p_name, m.p_name AS parent_name
       FROM part e LEFT JOIN part m ON m.p_partkey = CASE WHEN e.p_partkey > 0 THEN (e.p_partkey - 1) // 7 END""",
)
def join_self(t):
    child = t.part.select(
        "p_partkey", "p_name", F.when(F.col("p_partkey") > 0, F.expr("(p_partkey - 1) div 7")).alias("parent_key")
    )
    parent = t.part.select(F.col("p_partkey").alias("parent_key"), F.col("p_name").alias("parent_name"))
    return child.join(parent, "parent_key", "left").select("p_partkey", "p_name", "parent_name")


@section.query(
    "join_star_chain",
    """SELECT o_orderkey, c_name, n_name, p_name, l_quantity
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def join_star_chain(t):
    return (
        t.orders.where(in_year("o_orderdate", 1998))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select("o_orderkey", "c_name", "n_name", "p_name", "l_quantity")
    )


@section.query(
    "join_left_on_filter",
    """SELECT c_custkey, o_orderkey FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000""",
)
def join_left_on_filter(t):
    match = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > 450000)
    return t.customer.join(t.orders, match, "left").select("c_custkey", "o_orderkey")


@section.query(
    "join_left_where_filter",
    """SELECT c_custkey, o_orderkey FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 450000""",
)
def join_left_where_filter(t):
    joined = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.where(F.col("o_totalprice") > 450000).select("c_custkey", "o_orderkey")


@section.query(
    "join_anti_left_null",
    """SELECT o_orderkey, o_custkey FROM orders
       LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL""",
)
def join_anti_left_null(t):
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select(
        "o_orderkey", "o_custkey"
    )


@section.query(
    "join_semi_exists",
    """SELECT c_custkey, c_name FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
)
def join_semi_exists(t):
    large = t.orders.where("o_totalprice > 450000")
    return t.customer.join(large, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@section.query(
    "join_semi_multi",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS (
         SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
         WHERE o_custkey = c_custkey AND p_brand = 'Brand#12' AND l_quantity > 40)""",
)
def join_semi_multi(t):
    bought = (
        t.lineitem.where("l_quantity > 40")
        .join(t.part.where("p_brand = 'Brand#12'"), F.col("p_partkey") == F.col("l_partkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey")
    )
    return t.customer.join(bought, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@section.query(
    "join_anti_not_exists",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (
         SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 45)""",
)
def join_anti_not_exists(t):
    bulk = t.lineitem.where("l_quantity >= 45")
    return t.part.join(bulk, F.col("l_partkey") == F.col("p_partkey"), "left_anti").select("p_partkey", "p_name")


@section.query(
    "join_in_subquery",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def join_in_subquery(t):
    builders = t.customer.where("c_mktsegment = 'BUILDING'")
    return t.orders.join(builders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(
        "o_orderkey", "o_custkey"
    )


@section.query(
    "join_not_in_null_aware",
    """SELECT 'without null' AS list, p_partkey FROM part
       WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)
       UNION ALL
       SELECT 'with null', p_partkey FROM part
       WHERE p_partkey NOT IN (SELECT NULLIF(l_partkey, 7) FROM lineitem WHERE l_quantity >= 45)
       UNION ALL
       SELECT 'empty', p_partkey FROM part
       WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 1000)""",
)
def join_not_in_null_aware(t):
    bulk = t.lineitem.where("l_quantity >= 45").select("l_partkey")
    lists = {
        "without null": bulk,
        "with null": bulk.select(F.nullif("l_partkey", F.lit(7)).alias("l_partkey")),
        "empty": t.lineitem.where("l_quantity > 1000"),
    }
    kept = [
        J.not_in(t.part, "p_partkey", keys, "l_partkey").select(F.lit(name).alias("list"), "p_partkey")
        for name, keys in lists.items()
    ]
    return reduce(DataFrame.unionByName, kept)


def _orders_by_nation(t):
    return t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_nationkey", "o_orderkey", "o_totalprice", "o_orderdate"
    )



@section.query(
    "apply_cross_topn",
    """SELECT n_name, b.o_orderkey, b.o_totalprice FROM nation, LATERAL (
         SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey
         WHERE c_nationkey = n_nationkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) b""",
)
def apply_cross_topn(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return J.apply_first(t.nation, _orders_by_nation(t), "n_nationkey", "c_nationkey", order, 3).select(
        "n_name", "o_orderkey", "o_totalprice"
    )


@section.query(
    "apply_outer_topn",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
                  FROM orders WHERE o_totalprice > 300000)
       SELECT c_custkey, o_orderkey, o_orderdate, o_totalprice
       FROM customer LEFT JOIN r ON o_custkey = c_custkey AND rn <= 3""",
)
def apply_outer_topn(t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    large = t.orders.where("o_totalprice > 300000")
    return J.apply_first(t.customer, large, "c_custkey", "o_custkey", order, 3, keep_unmatched=True).select(
        "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


@section.query(
    "apply_outer_never",
    """SELECT p_partkey, p_name, CAST(NULL AS TIMESTAMP) AS l_shipdate FROM part WHERE p_partkey NOT IN (
         SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1998 AND l_quantity > 30)""",
)
def apply_outer_never(t):
    """Parts without a large shipment in 1998: the outer apply leaves them with NULL."""
    shipped = t.lineitem.where(in_year("l_shipdate", 1998) & (F.col("l_quantity") > 30)).select(
        "l_partkey", "l_shipdate"
    )
    return (
        J.apply_first(t.part, shipped, "p_partkey", "l_partkey", [F.col("l_shipdate").desc()], 1, True)
        .where(F.col("l_shipdate").isNull())
        .select("p_partkey", "p_name", "l_shipdate")
    )


@section.query(
    "apply_table_function",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) rn
                  FROM orders WHERE o_totalprice >= 200000)
       SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN r ON o_custkey = c_custkey AND rn = 1""",
)
def apply_table_function(t):
    t.spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION large_orders_of(customer BIGINT, least DOUBLE)
            RETURNS TABLE (o_orderkey BIGINT, o_totalprice DOUBLE)
            RETURN SELECT o_orderkey, o_totalprice FROM parquet.`{t.file_of("orders")}`
                   WHERE o_custkey = customer AND o_totalprice >= least"""
    )
    found = t.sql(
        """SELECT c_custkey, o.o_orderkey, o.o_totalprice
           FROM {customer}, LATERAL large_orders_of(c_custkey, 200000D) AS o""",
        "customer",
    )
    return J.first_per_key(found, ["c_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 1)


@section.query(
    "apply_agg_topn",
    """WITH g AS (SELECT c_nationkey, p_brand, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
                  JOIN part ON p_partkey = l_partkey GROUP BY ALL),
            r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY amount DESC, p_brand) rn FROM g)
       SELECT n_name, p_brand, CAST(amount AS DOUBLE) AS amount FROM nation JOIN r ON c_nationkey = n_nationkey
       WHERE rn <= 3""",
)
def apply_agg_topn(t):
    per_brand = (
        t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey", "p_brand")
        .agg(total("l_extendedprice").alias("amount"))
    )
    order = [F.col("amount").desc(), F.col("p_brand")]
    return J.apply_first(t.nation, per_brand, "n_nationkey", "c_nationkey", order, 3).select(
        "n_name", "p_brand", "amount"
    )


@section.query(
    "join_derived_key",
    """WITH o AS (SELECT year(o_orderdate) AS y, COUNT(*) AS n_orders FROM orders GROUP BY 1),
            l AS (SELECT year(l_shipdate) AS y, COUNT(*) AS n_lines FROM lineitem GROUP BY 1)
       SELECT CAST(o.y AS INTEGER) AS y, n_orders, n_lines FROM o JOIN l ON o.y = l.y""",
)
def join_derived_key(t):
    ordered = t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n_orders"))
    shipped = t.lineitem.groupBy(F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n_lines"))
    return ordered.join(shipped, "y")


@section.query(
    "join_fanout_guard",
    """SELECT o_orderkey, o_totalprice, n_lines, CAST(quantity AS DOUBLE) AS quantity
       FROM orders JOIN (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity
                         FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def join_fanout_guard(t):
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), total("l_quantity").alias("quantity")
    )
    return J.join_many_to_one(t.orders, per_order, ["o_orderkey"]).select(
        "o_orderkey", "o_totalprice", "n_lines", "quantity"
    )


@section.query(
    "join_agg_back",
    """WITH top AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders
                    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
       SELECT c_name, n_name, CAST(spent AS DOUBLE) AS spent FROM top
       JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
)
def join_agg_back(t):
    top = (
        t.orders.groupBy("o_custkey")
        .agg(total("o_totalprice").alias("spent"))
        .orderBy(F.col("spent").desc(), "o_custkey")
        .limit(10)
    )
    return (
        t.customer.join(F.broadcast(top), F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("c_name", "n_name", "spent")
    )


@section.query(
    "join_strategy_hints",
    " UNION ALL ".join(
        f"""SELECT '{s}' AS strategy, n_name AS name, COUNT(*) AS n FROM supplier
            JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"""
        for s in ("broadcast", "hash", "merge")
    )
    + """ UNION ALL SELECT 'nested_loop', r_name, COUNT(*) FROM nation JOIN region ON n_regionkey = r_regionkey
          GROUP BY r_name""",
)
def join_strategy_hints(t):
    """The same join under each strategy; the nested loop is for the two fixed-size dimensions only."""
    match = F.col("s_nationkey") == F.col("n_nationkey")
    parts = [
        J.join_with(t.supplier, t.nation, match, strategy).select(F.lit(strategy).alias("strategy"), F.col("n_name").alias("name"))
        for strategy in ("broadcast", "hash", "merge")
    ]
    parts.append(
        J.join_with(t.nation, t.region, F.col("n_regionkey") == F.col("r_regionkey"), "nested_loop").select(
            F.lit("nested_loop").alias("strategy"), F.col("r_name").alias("name")
        )
    )
    return reduce(DataFrame.unionByName, parts).groupBy("strategy", "name").agg(F.count(F.lit(1)).alias("n"))
