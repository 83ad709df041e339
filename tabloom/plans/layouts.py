"""Stored layouts, statistics profiles and skew reports."""

from pyspark.sql import functions as F

from tabloom.functions.predicates import in_year
from tabloom.operators import layout as L, profiles as P
from tabloom.operators.aggregates import salted_sum
from tabloom.operators.joins import salted_join
from tabloom.plans.registry import Section, cents, total
from tabloom.session import leaf_bytes, scratch_path
from tabloom.sources.tables import file_layout

section = Section()


@section.query(
    "layout_sorted", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 100 AND 300"
)
def layout_sorted(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    stored = L.write_sorted(orders, scratch_path(t.spark, "sorted"), ["o_custkey", "o_orderkey"])
    return stored.where(F.col("o_custkey").between(100, 300))


@section.query(
    "layout_covering",
    """SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent, MAX(o_orderdate) AS latest
       FROM orders GROUP BY 1""",
)
def layout_covering(t):
    stored = L.write_covering(
        t.orders, scratch_path(t.spark, "covering"), ["o_custkey"], ["o_orderdate", "o_totalprice"]
    )
    return stored.groupBy("o_custkey").agg(total("o_totalprice").alias("spent"), F.max("o_orderdate").alias("latest"))


@section.query(
    "layout_composite",
    "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'P' AND year(o_orderdate) = 1998",
)
def layout_composite(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    stored = L.write_partitioned(orders, scratch_path(t.spark, "composite"), "o_orderstatus", ["o_orderdate"])
    return stored.where((F.col("o_orderstatus") == "P") & in_year("o_orderdate", 1998))


@section.query(
    "layout_filtered",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000",
)
def layout_filtered(t):
    stored = L.write_filtered(
        t.orders, scratch_path(t.spark, "filtered"), F.col("o_orderstatus") == "P", ["o_orderdate"]
    )
    return stored.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


SMALL_BYTES = 256 * 1024


def small_files(t, columns):
    """The order lines cut into many small files; their number follows the bytes."""
    path = scratch_path(t.spark, "small-files")
    lines = t.lineitem.select(*columns)
    lines.repartition(1 + leaf_bytes(lines) // SMALL_BYTES).write.parquet(path)
    return path


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@section.query("compaction_report")
def compaction_report(t):
    """The stored order lines, and a copy cut into many small files."""
    stored = L.compaction_report(t.spark, t.file_of("lineitem")).select(F.lit("lineitem").alias("table_name"), "*")
    cut = L.compaction_report(t.spark, small_files(t, LINE_KEYS)).select(F.lit("small files").alias("table_name"), "*")
    return stored.unionByName(cut)


@section.query(
    "compaction_report_holds",
    """SELECT 'lineitem' AS table_name, COUNT(*) > 0 AS has_files, TRUE AS counts_bytes, TRUE AS keeps_rows FROM lineitem
       UNION ALL SELECT 'small files', COUNT(*) > 0, TRUE, TRUE FROM lineitem""",
)
def compaction_report_holds(t):
    """What must hold of the report: files are counted, their bytes add up, their rows are those of the table."""
    rows = t.lineitem.agg(F.count(F.lit(1))).first()[0]
    parts = []
    for name, path in (("lineitem", t.file_of("lineitem")), ("small files", small_files(t, LINE_KEYS))):
        layout = file_layout(t.spark, path).agg(F.count(F.lit(1)).alias("f"), F.sum("file_size").alias("b"), F.sum("n_rows").alias("r"))
        both = L.compaction_report(t.spark, path).crossJoin(layout)  # one row each
        parts.append(
            both.select(
                F.lit(name).alias("table_name"),
                ((F.col("n_files") > 0) & (F.col("n_files") == F.col("f"))).alias("has_files"),
                ((F.col("n_bytes") > 0) & (F.col("n_bytes") == F.col("b"))).alias("counts_bytes"),
                (F.col("r") == F.lit(rows)).alias("keeps_rows"),
            )
        )
    return parts[0].unionByName(parts[1])


@section.query("compact_files", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def compact_files(t):
    """Many small files rewritten as few: the content is the same."""
    return L.compact_files(t.spark, small_files(t, LINE_KEYS), scratch_path(t.spark, "compacted"))


def _histogram_sql(source, column, steps):
    return f"""SELECT step, MAX(value) AS high_value, max_by(n, value) AS eq_rows,
          CAST(SUM(n) - max_by(n, value) AS BIGINT) AS range_rows, COUNT(*) - 1 AS distinct_range_rows,
          COALESCE(CAST(SUM(n) - max_by(n, value) AS DOUBLE) / NULLIF(COUNT(*) - 1, 0), 0) AS avg_range_rows
        FROM (SELECT value, n, CAST((SUM(n) OVER (ORDER BY value) - n) * {steps} // SUM(n) OVER () AS INTEGER) AS step
              FROM (SELECT {column} AS value, COUNT(*) AS n FROM {source} GROUP BY 1))
        GROUP BY step"""


OLD = "(SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
NEW = "(SELECT CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE o_custkey END AS o_custkey FROM orders)"


@section.query("profile_histogram", _histogram_sql("orders", "o_custkey", 200))
def profile_histogram(t):
    return P.column_histogram(t.orders, "o_custkey", steps=200)


def old_orders(t):
    return t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select("o_custkey")


def new_orders(t):
    """A quarter of the orders moved to one customer."""
    return t.orders.select(F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(F.col("o_custkey")).alias("o_custkey"))


@section.query(
    "estimate_vs_actual",
    f"""WITH h AS ({_histogram_sql(OLD, 'o_custkey', 100)}),
        a AS (SELECT o_custkey, COUNT(*) AS actual_rows FROM {NEW} GROUP BY 1),
        e AS (SELECT a.*, CASE WHEN a.o_custkey = high_value THEN CAST(eq_rows AS DOUBLE) ELSE COALESCE(avg_range_rows, 0) END
                     AS estimated_rows FROM a ASOF LEFT JOIN h ON a.o_custkey <= high_value),
        q AS (SELECT *, GREATEST(GREATEST(estimated_rows, 1) / actual_rows, actual_rows / GREATEST(estimated_rows, 1)) AS q_error
              FROM e)
        SELECT o_custkey, actual_rows, estimated_rows, q_error, q_error >= 10 AS is_bad FROM q""",
)
def estimate_vs_actual(t):
    """A profile of the older orders against today's, in which one customer has grown."""
    histogram = P.column_histogram(old_orders(t), "o_custkey", steps=100)
    return P.estimate_vs_actual(histogram, new_orders(t), "o_custkey")


@section.query(
    "profile_drift",
    f"""WITH h AS (SELECT high_value, eq_rows + range_rows AS rows_before FROM ({_histogram_sql(OLD, 'o_custkey', 50)})),
        v AS (SELECT o_custkey, COUNT(*) AS n FROM {NEW} GROUP BY 1),
        a AS (SELECT high_value, CAST(SUM(n) AS BIGINT) AS rows_after, MAX(n) AS largest_after
              FROM v ASOF LEFT JOIN h ON v.o_custkey <= high_value GROUP BY 1),
        j AS (SELECT COALESCE(a.high_value, h.high_value) AS high_value, COALESCE(rows_before, 0) AS rows_before,
                     COALESCE(rows_after, 0) AS rows_after, COALESCE(largest_after, 0) AS largest_after
              FROM a FULL JOIN h ON a.high_value IS NOT DISTINCT FROM h.high_value)
        SELECT *, round(rows_after / (SELECT COUNT(*) FROM orders) - rows_before / (SELECT COUNT(*) FROM {OLD}), 6)
               AS share_change FROM j""",
)
def profile_drift(t):
    return P.profile_drift(old_orders(t), new_orders(t), "o_custkey", steps=50)


WHALE = """(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
            CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)"""


def whale_orders(t):
    """One customer holds a third of the orders."""
    customer = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    return t.orders.select("o_orderkey", customer.alias("o_custkey"), cents("o_totalprice").alias("price"))


@section.query(
    "skew_report",
    f"""SELECT o_custkey, COUNT(*) AS n_rows, COUNT(*) / (SELECT COUNT(*) FROM orders) AS share FROM {WHALE}
        GROUP BY 1 HAVING COUNT(*) >= 0.05 * (SELECT COUNT(*) FROM orders)""",
)
def skew_report(t):
    return P.skew_report(whale_orders(t), "o_custkey", share=0.05)


@section.query(
    "skew_salted_agg",
    f"SELECT o_custkey, COUNT(*) AS n_orders, CAST(SUM(price) AS DOUBLE) AS spent FROM {WHALE} GROUP BY 1",
)
def skew_salted_agg(t):
    sums = salted_sum(whale_orders(t), "o_custkey", {"n_orders": F.lit(1), "spent": F.col("price")})
    return sums.withColumn("spent", F.col("spent").cast("double"))


@section.query(
    "skew_salted_join", f"SELECT o_orderkey, o_custkey, c_name FROM {WHALE} JOIN customer ON c_custkey = o_custkey"
)
def skew_salted_join(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return salted_join(whale_orders(t).drop("price"), customers, "o_custkey")


@section.query(
    "selectivity_report",
    """SELECT o_orderstatus, n_rows, share, CASE WHEN share < 0.33 THEN 'pruned' ELSE 'scan' END AS access FROM (
         SELECT o_orderstatus, COUNT(*) AS n_rows, COUNT(*) / (SELECT COUNT(*) FROM orders) AS share FROM orders GROUP BY 1)""",
)
def selectivity_report(t):
    return P.selectivity(t.orders, "o_orderstatus", prune_below=0.33)


@section.query(
    "type_audit",
    """WITH l AS (SELECT DISTINCT CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN CAST(c_custkey AS VARCHAR)
                         ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS k FROM customer),
            r AS (SELECT DISTINCT o_custkey AS k FROM orders)
       SELECT 'string' AS left_type, 'bigint' AS right_type,
              COUNT(CASE WHEN TRY_CAST(k AS BIGINT) IS NULL THEN 1 END) AS left_not_convertible,
              CAST(0 AS BIGINT) AS right_not_convertible,
              COUNT(CASE WHEN k IN (SELECT CAST(k AS VARCHAR) FROM r) THEN 1 END) AS equal_as_text,
              COUNT(CASE WHEN TRY_CAST(k AS BIGINT) IN (SELECT k FROM r) THEN 1 END) AS equal_after_cast FROM l""",
)
def type_audit(t):
    key = F.col("c_custkey")
    code = (
        F.when(key % 5 == 0, F.col("c_name"))
        .when(key % 5 == 1, key.cast("string"))
        .otherwise(F.lpad(key.cast("string"), 10, "0"))
    )
    return P.type_audit(t.customer.select(code.alias("code")), "code", t.orders, "o_custkey")
