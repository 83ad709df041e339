"""Insert, update, delete, merge and ledger jobs on the part and customer tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabloom.operators import changes as C
from tabloom.operators.ledger import post_batch
from tabloom.plans.registry import Section
from tabloom.session import scratch_path
from tabloom.sources.snapshots import SnapshotTable

section = Section()
P_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
TARGET = "SELECT p_partkey, p_size AS stock_qty FROM part WHERE p_partkey % 10 <> 0"
SOURCE = """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size + 5 ELSE p_size END AS stock_qty
            FROM part WHERE p_partkey % 7 <> 0"""


def stock_target(t):
    return t.part.where("p_partkey % 10 <> 0").select("p_partkey", F.col("p_size").alias("stock_qty"))


def stock_source(t):
    quantity = F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") + 5).otherwise(F.col("p_size"))
    return t.part.where("p_partkey % 7 <> 0").select("p_partkey", quantity.alias("stock_qty"))


def staging(t):
    """Parts as a staging table with defaults for two columns."""
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(19,4)").alias("list_price"),
        (F.col("p_size") > 5).alias("is_active"),
    )


STAGING = """SELECT p_partkey AS product_id, p_name AS name, CAST(p_retailprice AS DECIMAL(19,4)) AS list_price,
             p_size > 5 AS is_active FROM part"""


@section.query(
    "dml_insert_values",
    STAGING
    + """ UNION ALL SELECT * FROM (VALUES (-1, 'Test A', CAST(10 AS DECIMAL(19,4)), TRUE),
          (-2, 'Test B', CAST(20 AS DECIMAL(19,4)), TRUE), (-3, 'Test C', CAST(30 AS DECIMAL(19,4)), TRUE))""",
)
def dml_insert_values(t):
    rows = t.spark.sql(
        "SELECT * FROM VALUES (-1, 'Test A', 10.00), (-2, 'Test B', 20.00), (-3, 'Test C', 30.00) AS v(product_id, name, list_price)"
    )
    return C.insert_rows(staging(t), rows, {"is_active": F.lit(True)}).state


@section.query(
    "dml_insert_select",
    f"""{TARGET} UNION ALL SELECT p_partkey, p_size FROM part WHERE p_partkey % 10 = 0 AND p_type = 'PROMO'""",
)
def dml_insert_select(t):
    promo = t.part.where("p_type = 'PROMO'").select("p_partkey", F.col("p_size").alias("stock_qty"))
    return C.insert_missing(stock_target(t), promo, ["p_partkey"]).state


@section.query(
    "dml_insert_output", "SELECT p_partkey, p_size AS stock_qty FROM part WHERE p_partkey % 10 = 0 AND p_type = 'PROMO'"
)
def dml_insert_output(t):
    promo = t.part.where("p_type = 'PROMO'").select("p_partkey", F.col("p_size").alias("stock_qty"))
    return C.insert_missing(stock_target(t), promo, ["p_partkey"]).output


@section.query(
    "dml_update_output",
    f"""SELECT product_id, list_price AS old_list_price, CAST(list_price * 1.05 AS DECIMAL(19,4)) AS new_list_price
        FROM ({STAGING}) WHERE name LIKE 'red%'""",
)
def dml_update_output(t):
    raised = F.col("list_price") * F.lit("1.05").cast("decimal(3,2)")
    return C.update_where(staging(t), ["product_id"], F.col("name").like("red%"), {"list_price": raised}).output


@section.query(
    "dml_update_from",
    f"""SELECT t.p_partkey, CASE WHEN s.p_partkey IS NOT NULL THEN s.stock_qty ELSE t.stock_qty END AS stock_qty
        FROM ({TARGET}) t LEFT JOIN (SELECT p_partkey, NULLIF(stock_qty, 7) AS stock_qty FROM ({SOURCE})) s
        ON s.p_partkey = t.p_partkey""",
)
def dml_update_from(t):
    source = stock_source(t).withColumn("stock_qty", F.nullif("stock_qty", F.lit(7)))
    return C.update_from(stock_target(t), source, ["p_partkey"], {"stock_qty": "stock_qty"}).state


@section.query(
    "dml_delete_output",
    f"""SELECT 'deleted' AS part_of, product_id, name FROM ({STAGING}) WHERE NULLIF(is_active, name = 'red ring') = FALSE
        UNION ALL
        SELECT 'state', product_id, name FROM ({STAGING}) WHERE NULLIF(is_active, name = 'red ring') IS DISTINCT FROM FALSE""",
)
def dml_delete_output(t):
    inactive = F.nullif(F.col("is_active"), F.col("name") == "red ring") == F.lit(False)
    change = C.delete_where(staging(t), inactive)
    deleted = change.output.select(F.lit("deleted").alias("part_of"), "product_id", "name")
    return deleted.unionByName(change.state.select(F.lit("state").alias("part_of"), "product_id", "name"))


@section.query(
    "dml_delete_join",
    f"""SELECT p_partkey, stock_qty FROM ({TARGET}) WHERE p_partkey NOT IN (
          SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)""",
)
def dml_delete_join(t):
    bulk = t.lineitem.where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return C.delete_matching(stock_target(t), bulk, ["p_partkey"]).state


FEED = "SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS day FROM events"


@section.query(
    "dedup_delete",
    f"""SELECT event_id, ts, user_id, event_type, day FROM (SELECT *, ROW_NUMBER() OVER (
          PARTITION BY user_id, day, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM ({FEED})) WHERE rn = 1""",
)
def dedup_delete(t):
    feed = t.events.select("event_id", "ts", "user_id", "event_type", F.to_date("ts").alias("day"))
    return C.delete_copies(feed, ["user_id", "day", "event_type"], ["ts", "event_id"]).state


def stock_merge(t, delete_unmatched):
    return C.merge(
        stock_target(t),
        stock_source(t),
        ["p_partkey"],
        update={"stock_qty": F.col("s.stock_qty")},
        insert={"p_partkey": F.col("s.p_partkey"), "stock_qty": F.col("s.stock_qty")},
        changed=F.col("s.stock_qty") != F.col("t.stock_qty"),
        delete_unmatched=delete_unmatched,
    )


@section.query("dml_merge_full", SOURCE)
def dml_merge_full(t):
    return stock_merge(t, delete_unmatched=True).state


@section.query(
    "dml_merge_log",
    f"""SELECT CASE WHEN t.p_partkey IS NULL THEN 'INSERT' WHEN s.p_partkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END
               AS merge_action, s.p_partkey AS inserted_p_partkey, t.p_partkey AS deleted_p_partkey
        FROM ({TARGET}) t FULL JOIN ({SOURCE}) s ON s.p_partkey = t.p_partkey
        WHERE t.p_partkey IS NULL OR s.p_partkey IS NULL OR s.stock_qty <> t.stock_qty""",
)
def dml_merge_log(t):
    return stock_merge(t, delete_unmatched=True).output


@section.query(
    "dml_merge_upsert",
    f"""SELECT COALESCE(s.p_partkey, t.p_partkey) AS p_partkey, COALESCE(s.stock_qty, t.stock_qty) AS stock_qty
        FROM ({TARGET}) t FULL JOIN ({SOURCE}) s ON s.p_partkey = t.p_partkey""",
)
def dml_merge_upsert(t):
    return stock_merge(t, delete_unmatched=False).state


@section.query(
    "dml_update_topn",
    """SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) <= 10000
              THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def dml_update_topn(t):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    change = C.update_first(
        orders, ["o_orderkey"], ["o_totalprice desc", "o_orderkey"], 10000, {"o_orderpriority": F.lit("1-URGENT")}
    )
    return change.state.select("o_orderkey", "o_orderpriority")


@section.query(
    "dml_update_modulo",
    """SELECT p_partkey, p_name || CASE WHEN p_partkey % 5 = 0 THEN repeat('x', 20) ELSE '' END AS p_name FROM part""",
)
def dml_update_modulo(t):
    longer = F.concat("p_name", F.repeat(F.lit("x"), F.lit(20)))
    parts = t.part.select("p_partkey", "p_name")
    return C.update_where(parts, ["p_partkey"], F.col("p_partkey") % 5 == 0, {"p_name": longer}).state


def accounts(t):
    balance = (F.col("c_acctbal") + 2000).cast("decimal(14,2)")
    return t.customer.select(F.col("c_custkey").alias("account_id"), balance.alias("balance"))


def transfers(t, factor):
    """Every account pays one other; ``factor`` scales the amounts."""
    n = t.customer.agg(F.count(F.lit(1))).scalar()
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("from_id"),
        ((key * 7 + 3) % n).alias("to_id"),
        ((key % 100) * factor).cast("decimal(14,2)").alias("amount"),
    )


POSTED_AT = "2024-01-31 00:00:00"


def posted(t, factor):
    at = F.lit(POSTED_AT).cast("timestamp_ntz")
    return post_batch(accounts(t), transfers(t, factor), f"batch-{factor}", at)


def _ledger_sql(factor):
    return f"""WITH a AS (SELECT c_custkey AS account_id, CAST(c_acctbal + 2000 AS DECIMAL(14,2)) AS balance FROM customer),
        x AS (SELECT c_custkey AS from_id, (c_custkey * 7 + 3) % (SELECT COUNT(*) FROM customer) AS to_id,
                     CAST(c_custkey % 100 * {factor} AS DECIMAL(14,2)) AS amount FROM customer),
        d AS (SELECT account_id, SUM(change) AS change FROM (
                SELECT from_id AS account_id, -amount AS change FROM x UNION ALL SELECT to_id, amount FROM x) GROUP BY 1),
        r AS (SELECT account_id, CAST(balance + change AS DECIMAL(14,2)) AS balance_after FROM a JOIN d USING (account_id)
              WHERE change < 0 AND balance + change < 0)"""


@section.query(
    "ledger_apply",
    _ledger_sql(1)
    + """ SELECT account_id, CAST(CASE WHEN (SELECT COUNT(*) FROM r) = 0 THEN balance + COALESCE(change, 0) ELSE balance END
          AS DECIMAL(14,2)) AS balance FROM a LEFT JOIN d USING (account_id)""",
)
def ledger_apply(t):
    return posted(t, 1).state


@section.query(
    "ledger_reject",
    _ledger_sql(80)
    + """ SELECT account_id, reason, amount FROM (
            SELECT account_id, 'insufficient balance' AS reason, balance_after AS amount FROM r
            UNION ALL SELECT account_id, 'kept', balance FROM a WHERE (SELECT COUNT(*) FROM r) > 0)""",
)
def ledger_reject(t):
    """The refused batch: why, and the unchanged state."""
    result = posted(t, 80)
    reasons = result.reasons.select("account_id", "reason", F.col("balance_after").alias("amount"))
    return reasons.unionByName(result.state.select("account_id", F.lit("kept").alias("reason"), F.col("balance").alias("amount")))


@section.query(
    "ledger_log",
    f"""SELECT 'batch-1' AS batch_id, COUNT(*) AS n_transfers, CAST(SUM(c_custkey % 100) AS DOUBLE) AS amount,
               TIMESTAMP '{POSTED_AT}' AS posted_at FROM customer""",
)
def ledger_log(t):
    """Only the accepted one of two batches is logged."""
    logs = [posted(t, factor).log for factor in (1, 80)]
    return reduce(DataFrame.unionByName, logs).withColumn("amount", F.col("amount").cast("double"))


@section.query("idempotent_rebuild", f"SELECT 2 AS version, p_partkey, stock_qty FROM ({TARGET})")
def idempotent_rebuild(t):
    """Rebuilding a table from its source: a second run publishes the same content again."""
    table = SnapshotTable(t.spark, scratch_path(t.spark, "stock"))
    table.publish(stock_target(t))
    version = table.publish(stock_target(t))
    return table.read().select(F.lit(version).alias("version"), "p_partkey", "stock_qty")
