"""Keys, references, checks, defaults and ids as data-quality queries."""

from pyspark.sql import functions as F

from tabloom.operators import rules as R
from tabloom.operators.changes import insert_rows
from tabloom.plans.registry import Section, cents

section = Section()


@section.query(
    "rule_primary_key",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM (
         SELECT NULLIF(l_orderkey, 17) AS l_orderkey, l_linenumber FROM lineitem)
       GROUP BY 1, 2 HAVING COUNT(*) > 1 OR l_orderkey IS NULL""",
)
def rule_primary_key(t):
    lines = t.lineitem.select(F.nullif("l_orderkey", F.lit(17)).alias("l_orderkey"), "l_linenumber")
    return R.key_violations(lines, ["l_orderkey", "l_linenumber"])


PRICES = "SELECT CASE WHEN p_size = 7 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price FROM part"


@section.query(
    "rule_unique",
    f"""SELECT 'one null' AS rule, price, COUNT(*) AS n_rows FROM ({PRICES}) GROUP BY 2 HAVING COUNT(*) > 1
        UNION ALL
        SELECT 'any nulls', price, COUNT(*) FROM ({PRICES}) WHERE price IS NOT NULL GROUP BY 2 HAVING COUNT(*) > 1""",
)
def rule_unique(t):
    prices = t.part.select(F.when(F.col("p_size") != 7, cents("p_retailprice")).alias("price"))
    one = R.key_violations(prices, ["price"], primary=False)
    any_ = R.key_violations(prices, ["price"], primary=False, nulls_distinct=True)
    return one.select(F.lit("one null").alias("rule"), "price", "n_rows").unionByName(
        any_.select(F.lit("any nulls").alias("rule"), "price", "n_rows")
    )


@section.query(
    "rule_foreign_key",
    """SELECT 'orphan' AS finding, o_orderkey AS key FROM orders
       WHERE o_orderkey % 50 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
       UNION ALL
       SELECT 'referenced', c_custkey FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 <> 0 AND o_totalprice > 400000)""",
)
def rule_foreign_key(t):
    """Orders without a customer in good standing (NULL keys pass), and customers that may not be deleted."""
    orders = t.orders.select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey")
    )
    solvent = t.customer.where("c_acctbal >= 0")
    orphans = R.orphans(orders, ["o_custkey"], solvent, ["c_custkey"])
    held = R.referenced(t.customer, ["c_custkey"], orders.where("o_totalprice > 400000"), ["o_custkey"])
    return orphans.select(F.lit("orphan").alias("finding"), F.col("o_orderkey").alias("key")).unionByName(
        held.select(F.lit("referenced").alias("finding"), F.col("c_custkey").alias("key"))
    )


@section.query(
    "rule_check",
    """SELECT c_custkey, 'check(balance)' AS reason FROM customer
       WHERE CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END < 0""",
)
def rule_check(t):
    """Unknown balances pass the check."""
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    customers = t.customer.select("c_custkey", balance.alias("balance"))
    rejected = R.split_by_rules(customers, [R.Check("balance", "balance >= 0")]).rejected
    return rejected.select("c_custkey", F.explode("reasons").alias("reason"))


@section.query(
    "rule_not_null_type",
    """SELECT o_orderkey, 'not_null(priority)' AS reason FROM orders WHERE o_orderpriority = '5-LOW'
       UNION ALL SELECT o_orderkey, 'max_length(priority)' FROM orders WHERE o_orderpriority <> '5-LOW' AND length(o_orderpriority) > 8
       UNION ALL SELECT o_orderkey, 'type(price)' FROM orders WHERE o_totalprice >= 99999.995""",
)
def rule_not_null_type(t):
    orders = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    rules = [R.NotNull("priority"), R.MaxLength("priority", 8), R.FitsType("price", "decimal(7,2)")]
    return R.split_by_rules(orders, rules).rejected.select("o_orderkey", F.explode("reasons").alias("reason"))


@section.query(
    "rule_default",
    """SELECT p_partkey, NULLIF(p_type, 'ECONOMY') AS kind, 0 AS stock_qty FROM part
       UNION ALL SELECT -1 - p_partkey, 'unknown', p_size FROM part WHERE p_size > 45""",
)
def rule_default(t):
    """Explicit NULLs stay NULL; only columns an insert leaves out get the default."""
    target = t.part.where(F.lit(False)).select("p_partkey", F.col("p_type").alias("kind"), F.col("p_size").alias("stock_qty"))
    defaults = {"kind": F.lit("unknown"), "stock_qty": F.lit(0)}
    explicit = t.part.select("p_partkey", F.nullif("p_type", F.lit("ECONOMY")).alias("kind"))
    sized = t.part.where("p_size > 45").select(
        (-1 - F.col("p_partkey")).alias("p_partkey"), F.col("p_size").alias("stock_qty")
    )
    first = insert_rows(target, explicit, defaults).state
    return insert_rows(first, sized, defaults).state


@section.query(
    "assign_identity",
    """SELECT 100 + 5 * (ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) - 1) AS account_no, c_custkey FROM customer""",
)
def assign_identity(t):
    customers = t.customer.select("c_custkey", "c_acctbal")
    return R.assign_ids(customers, ["c_acctbal", "c_custkey"], "account_no", seed=100, step=5).drop("c_acctbal")


@section.query(
    "assign_sequence",
    """SELECT 999 + ROW_NUMBER() OVER (ORDER BY c_custkey) AS party_id, c_name AS name FROM customer
       UNION ALL SELECT 999 + (SELECT COUNT(*) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_suppkey), s_name FROM supplier""",
)
def assign_sequence(t):
    """Suppliers go on where the ids of the customers end."""
    customers = R.assign_ids(
        t.customer.select("c_custkey", F.col("c_name").alias("name")), ["c_custkey"], "party_id", seed=1000
    )
    suppliers = R.assign_ids(
        t.supplier.select("s_suppkey", F.col("s_name").alias("name")),
        ["s_suppkey"],
        "party_id",
        seed=R.next_id(customers, "party_id", first=1000),
    )
    return customers.select("party_id", "name").unionByName(suppliers.select("party_id", "name"))


@section.query(
    "computed_column",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)
              AS line_total, l_returnflag || ' (shipped: ' || strftime(l_shipdate, '%Y-%m-%d') || ')' AS label FROM lineitem""",
)
def computed_column(t):
    lines = t.lineitem.withColumn(
        "line_total", (cents("l_quantity") * cents("l_extendedprice")).cast("double")
    ).withColumn(
        "label",
        F.concat("l_returnflag", F.lit(" (shipped: "), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(")")),
    )
    return lines.select("l_orderkey", "l_linenumber", "line_total", "label")


@section.query(
    "schema_add_column",
    """SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS phone FROM supplier
       UNION ALL SELECT -1 - s_suppkey, s_name, '555-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') FROM supplier""",
)
def schema_add_column(t):
    suppliers = t.supplier.select("s_suppkey", "s_name")
    phone = F.concat(F.lit("555-"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0"))
    newer = t.supplier.select((-1 - F.col("s_suppkey")).alias("s_suppkey"), "s_name", phone.alias("phone"))
    return R.add_columns(suppliers, {"phone": "string"}, newer)


@section.query(
    "rule_quarantine",
    """WITH x AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day, ROW_NUMBER() OVER (
                    PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY event_id) AS rn FROM events),
       m AS (SELECT event_id, concat_ws(';',
               CASE WHEN NOT value >= 1 THEN 'check(value)' END,
               CASE WHEN rn > 1 THEN 'unique(user_id,day,event_type)' END,
               CASE WHEN user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'foreign_key(user_id)' END)
             AS reasons FROM x)
       SELECT event_id, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS verdict, reasons FROM m""",
)
def rule_quarantine(t):
    events = t.events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    solvent = t.customer.where("c_acctbal >= 0")
    rules = [
        R.Check("value", "value >= 1"),
        R.Key(("user_id", "day", "event_type"), order=("event_id",)),
        R.Reference(("user_id",), solvent, ("c_custkey",)),
    ]
    split = R.split_by_rules(events, rules)
    accepted = split.accepted.select("event_id", F.lit("accepted").alias("verdict"), F.lit("").alias("reasons"))
    rejected = split.rejected.select(
        "event_id", F.lit("rejected").alias("verdict"), F.array_join("reasons", ";").alias("reasons")
    )
    return accepted.unionByName(rejected)
