"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from tabloom.functions import predicates as P
from tabloom.plans.registry import Section

section = Section()


def part_with_gaps():
    """A color that is NULL for some parts; the tables themselves hold no NULL."""
    return F.nullif(F.col("p_type"), F.lit("ECONOMY"))


@section.query(
    "project_alias", "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer"
)
def project_alias(t):
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


@section.query(
    "filter_compare",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_linestatus <> 'O'",
)
def filter_compare(t):
    return t.lineitem.where((F.col("l_quantity") >= 45) & (F.col("l_linestatus") != "O")).select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@section.query(
    "filter_and_or",
    """SELECT p_partkey, p_brand, p_size FROM part
       WHERE (p_type = 'PROMO' AND p_size > 25) OR (NOT p_brand = 'Brand#1' AND p_retailprice > 990)""",
)
def filter_and_or(t):
    promo = (F.col("p_type") == "PROMO") & (F.col("p_size") > 25)
    dear = ~(F.col("p_brand") == "Brand#1") & (F.col("p_retailprice") > 990)
    return t.part.where(promo | dear).select("p_partkey", "p_brand", "p_size")


@section.query("filter_like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like_prefix(t):
    return t.part.where(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@section.query("filter_like_contains", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%gi%'")
def filter_like_contains(t):
    return t.part.where(F.col("p_name").like("%gi%")).select("p_partkey", "p_name")


@section.query("filter_like_wildcard", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '_ed ri__'")
def filter_like_wildcard(t):
    return t.part.where(F.col("p_name").like("_ed ri__")).select("p_partkey", "p_name")


@section.query("filter_like_suffix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'")
def filter_like_suffix(t):
    return t.part.where(F.col("p_name").like("%bolt")).select("p_partkey", "p_name")


@section.query("filter_like_ci", "SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%rom%'")
def filter_like_ci(t):
    return t.part.where(F.col("p_type").ilike("%rom%")).select("p_partkey", "p_type")


@section.query(
    "filter_not_like",
    """SELECT p_partkey, p_name, NULLIF(p_type, 'ECONOMY') AS color FROM part
       WHERE p_name NOT LIKE '%ring%' AND NULLIF(p_type, 'ECONOMY') IS NOT NULL""",
)
def filter_not_like(t):
    parts = t.part.select("p_partkey", "p_name", part_with_gaps().alias("color"))
    return parts.where(~F.col("p_name").like("%ring%") & F.col("color").isNotNull())


@section.query(
    "filter_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_in_list(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@section.query(
    "filter_between", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice BETWEEN 910 AND 950"
)
def filter_between(t):
    return t.part.where(F.col("p_retailprice").between(910, 950)).select("p_partkey", "p_retailprice")


@section.query(
    "filter_between_dates",
    """SELECT event_id, ts FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'""",
)
def filter_between_dates(t):
    return t.events.where(P.between_dates("ts", "2024-01-05", "2024-01-10")).select("event_id", "ts")


@section.query(
    "filter_half_open_range",
    """SELECT event_id, ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""",
)
def filter_half_open_range(t):
    return t.events.where(P.day_range("ts", "2024-01-05", "2024-01-10")).select("event_id", "ts")


@section.query("filter_is_null", "SELECT p_partkey, p_brand FROM part WHERE NULLIF(p_type, 'ECONOMY') IS NULL")
def filter_is_null(t):
    return t.part.where(part_with_gaps().isNull()).select("p_partkey", "p_brand")


@section.query("filter_eq_null_empty", "SELECT p_partkey FROM part WHERE NULLIF(p_type, 'ECONOMY') = NULL")
def filter_eq_null_empty(t):
    return t.part.where(part_with_gaps() == F.lit(None).cast("string")).select("p_partkey")


@section.query("distinct_values", "SELECT DISTINCT NULLIF(p_type, 'ECONOMY') AS color FROM part")
def distinct_values(t):
    return t.part.select(part_with_gaps().alias("color")).distinct()


@section.query(
    "case_simple",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Other' END
       AS status_label FROM orders""",
)
def case_simple(t):
    status = F.col("o_orderstatus")
    label = F.when(status == "F", "Finished").when(status == "O", "Open").otherwise("Other")
    return t.orders.select("o_orderkey", label.alias("status_label"))


@section.query(
    "case_searched",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'High' WHEN o_totalprice > 150000 THEN 'Mid'
       ELSE 'Low' END AS tier FROM orders""",
)
def case_searched(t):
    price = F.col("o_totalprice")
    tier = F.when(price > 400000, "High").when(price > 150000, "Mid").otherwise("Low")
    return t.orders.select("o_orderkey", tier.alias("tier"))


@section.query(
    "project_computed",
    """SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label, 'Customer' AS source,
              CAST(c_acctbal AS DECIMAL(18,2)) - 100 AS above_floor FROM customer""",
)
def project_computed(t):
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("label"),
        F.lit("Customer").alias("source"),
        (F.col("c_acctbal").cast("decimal(18,2)") - 100).alias("above_floor"),
    )


@section.query("filter_modulo", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 7 = 0")
def filter_modulo(t):
    return t.orders.where(F.col("o_orderkey") % 7 == 0).select("o_orderkey", "o_custkey")


def orders_of_status(t, status: str, least: float = 0.0):
    return t.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice >= :least",
        "orders",
        args={"status": status, "least": least},
    )


@section.query(
    "param_filter",
    """SELECT 'all' AS kind, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 0
       UNION ALL
       SELECT 'large', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 300000""",
)
def param_filter(t):
    every = orders_of_status(t, "P").select(F.lit("all").alias("kind"), "o_orderkey", "o_totalprice")
    large = orders_of_status(t, "F", 300000.0).select(F.lit("large").alias("kind"), "o_orderkey", "o_totalprice")
    return every.unionByName(large)


@section.query(
    "filter_year_sargable", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997"
)
def filter_year_sargable(t):
    return t.orders.where(P.in_year("o_orderdate", 1997)).select("o_orderkey", "o_orderdate")


@section.query(
    "filter_month_sargable",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-12'",
)
def filter_month_sargable(t):
    return t.orders.where(P.in_month("o_orderdate", "1998-12")).select("o_orderkey", "o_orderdate")


@section.query(
    "filter_isnull_rewrite",
    "SELECT p_partkey FROM part WHERE COALESCE(NULLIF(p_type, 'ECONOMY'), 'PROMO') = 'PROMO'",
)
def filter_isnull_rewrite(t):
    parts = t.part.select("p_partkey", part_with_gaps().alias("color"))
    return parts.where(P.equals_or_null("color", "PROMO")).select("p_partkey")


@section.query(
    "filter_typed_literal",
    """SELECT 'exact' AS form, c_custkey FROM customer WHERE c_name = 'Customer#' || lpad('42', 9, '0')
       UNION ALL
       SELECT 'number', c_custkey FROM customer
       WHERE TRY_CAST(CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE substr(c_name, 10) END AS BIGINT) = 42""",
)
def filter_typed_literal(t):
    exact = t.customer.where(P.equals_typed("c_name", "Customer#000000042", "string"))
    dirty = F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).otherwise(F.substring("c_name", 10, 9))
    number = t.customer.where(P.equals_number(dirty, 42))
    return exact.select(F.lit("exact").alias("form"), "c_custkey").unionByName(
        number.select(F.lit("number").alias("form"), "c_custkey")
    )


WORDS = r"regexp_split_to_array(lower(text), '\W+')"


@section.query("filter_contains_word", f"SELECT doc_id, lang FROM documents WHERE list_contains({WORDS}, 'with')")
def filter_contains_word(t):
    return t.documents.where(P.has_word("text", "with")).select("doc_id", "lang")


@section.query(
    "filter_any_word",
    f"SELECT doc_id, lang FROM documents WHERE list_has_any({WORDS}, ['der', 'que', 'with'])",
)
def filter_any_word(t):
    return t.documents.where(P.has_any_word("text", ["der", "que", "with"])).select("doc_id", "lang")
