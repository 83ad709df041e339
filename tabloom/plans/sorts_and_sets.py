"""Sorting, limits, paging and set operations."""

from pyspark.sql import functions as F

from tabloom.operators import ordering as O
from tabloom.plans.registry import Section

section = Section()


@section.query(
    "sort_multi",
    "SELECT p_type AS kind, p_size, p_partkey FROM part ORDER BY kind, p_size DESC, p_partkey",
)
def sort_multi(t):
    return t.part.select(F.col("p_type").alias("kind"), "p_size", "p_partkey").orderBy(
        "kind", F.col("p_size").desc(), "p_partkey"
    )


@section.query(
    "topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
)
def topk(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@section.query(
    "page_offset_fetch",
    """SELECT * FROM (SELECT 'near' AS page, o_orderkey, o_totalprice FROM orders
                      ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20)
       UNION ALL
       SELECT * FROM (SELECT 'deep' AS page, o_orderkey, o_totalprice FROM orders
                      ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 12345)""",
)
def page_offset_fetch(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    order = ["o_totalprice desc", "o_orderkey"]
    near = O.page(orders, order, offset=20, fetch=10)
    deep = O.page(orders, order, offset=12345, fetch=25)
    return near.select(F.lit("near").alias("page"), "*").unionByName(deep.select(F.lit("deep").alias("page"), "*"))


@section.query("limit_any")
def limit_any(t):
    return t.lineitem.limit(10)


@section.query("limit_any_holds", "SELECT LEAST(COUNT(*), 10) AS n_rows, LEAST(COUNT(*), 10) AS n_from_table FROM lineitem")
def limit_any_holds(t):
    """Ten rows, whichever they are, all of them rows of the table."""
    some = t.lineitem.limit(10).select("l_orderkey", "l_linenumber", "l_partkey").withColumn("_row", F.monotonically_increasing_id())
    known = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").distinct().withColumn("_known", F.lit(1))
    joined = some.join(known, ["l_orderkey", "l_linenumber", "l_partkey"], "left")
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count("_known").alias("n_from_table"))


@section.query(
    "topk_in_view",
    """WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20)
       SELECT * FROM t ORDER BY c_name""",
)
def topk_in_view(t):
    top = t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(20)
    top.createOrReplaceTempView("top_balances")
    return t.spark.table("top_balances").orderBy("c_name")


@section.query(
    "sort_large",
    """SELECT l_shipdate, l_extendedprice, l_orderkey, l_linenumber FROM lineitem
       ORDER BY l_shipdate, l_extendedprice DESC, l_orderkey, l_linenumber""",
)
def sort_large(t):
    return t.lineitem.select("l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"
    )


@section.query("topn_with_ties", """SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= (
    SELECT MIN(p_retailprice) FROM (SELECT p_retailprice FROM part ORDER BY 1 DESC LIMIT 5))""")
def topn_with_ties(t):
    return O.top_with_ties(t.part.select("p_partkey", "p_retailprice"), 5, "p_retailprice")


def _nations(t):
    return t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(
        F.col("s_nationkey").alias("nation")
    )


@section.query(
    "set_union_all",
    "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def set_union_all(t):
    customers, suppliers = _nations(t)
    return customers.union(suppliers)


@section.query(
    "set_union",
    "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0",
)
def set_union(t):
    spenders = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    debtors = t.customer.where("c_acctbal < 0").select("c_custkey")
    return spenders.union(debtors).distinct()


@section.query(
    "set_intersect",
    """SELECT o_custkey AS k, NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders WHERE o_orderstatus = 'F'
       INTERSECT
       SELECT o_custkey, NULLIF(o_orderpriority, '5-LOW') FROM orders WHERE o_orderstatus = 'O'""",
)
def set_intersect(t):
    priority = F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    finished, open_ = (
        t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"), priority) for s in "FO"
    )
    return finished.intersect(open_)


@section.query(
    "set_except",
    """SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
       EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""",
)
def set_except(t):
    finished, open_ = (
        t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FO"
    )
    return finished.subtract(open_)


@section.query(
    "set_union_labelled",
    """SELECT c_name AS name, 'Customer' AS source FROM customer
       UNION ALL SELECT s_name, 'Supplier' FROM supplier ORDER BY name""",
)
def set_union_labelled(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.lit("Customer").alias("source"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.lit("Supplier").alias("source"))
    return customers.union(suppliers).orderBy("name")
