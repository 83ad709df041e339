"""Streaming forms of the batch queries, run until the input is used up."""

from pyspark.sql import functions as F

from tabloom.functions.amounts import units
from tabloom.operators import rules as R
from tabloom.plans.registry import Section, total
from tabloom.plans.table_changes import SOURCE, TARGET, stock_target
from tabloom.session import scratch_path
from tabloom.streaming import aggregates as A, feeds, tables
from tabloom.streaming.balances import debit_stream

section = Section()
# The span of the events: no row is too late, in whatever order files arrive.
WHOLE_SPAN = "31 days"
EXACT = "CAST(value AS DECIMAL(18,2))"


def _measures():
    return {"n": F.count(F.lit(1)), "amount": total("value")}


def event_stream(t, **options):
    return feeds.stream_files(t.spark, t.file_of("events"), t.events.schema, **options)


@section.query(
    "stream_tumbling",
    f"""SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
               COUNT(*) AS n, CAST(SUM({EXACT}) AS DOUBLE) AS amount FROM events GROUP BY ALL""",
)
def stream_tumbling(t):
    return feeds.run_windowed(
        t.spark, t.file_of("events"), "ts", WHOLE_SPAN,
        lambda s: A.tumbling(s, "ts", "1 day", ["event_type"], _measures()),
    ).windows


@section.query(
    "stream_sliding",
    f"""SELECT window_start, window_start + INTERVAL 3 DAY AS window_end, event_type, COUNT(*) AS n,
               CAST(SUM({EXACT}) AS DOUBLE) AS amount, CAST(SUM({EXACT}) AS DOUBLE) / COUNT(*) AS average
        FROM (SELECT *, date_trunc('day', ts) - INTERVAL 1 DAY * back AS window_start FROM events, range(0, 3) b(back))
        GROUP BY window_start, event_type""",
)
def stream_sliding(t):
    totals = feeds.run_windowed(
        t.spark, t.file_of("events"), "ts", WHOLE_SPAN,
        lambda s: A.sliding(s, "ts", "3 days", "1 day", ["event_type"], _measures()),
    ).windows
    return totals.withColumn("average", F.col("amount") / F.col("n"))


@section.query(
    "stream_sessions",
    f"""WITH m AS (SELECT *, CASE WHEN ts < LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS starts
                   FROM events),
             s AS (SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM m)
        SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL 12 HOUR AS window_end, user_id, COUNT(*) AS n,
               CAST(SUM({EXACT}) AS DOUBLE) AS amount FROM s GROUP BY user_id, session_no""",
)
def stream_sessions(t):
    return feeds.run_windowed(
        t.spark, t.file_of("events"), "ts", WHOLE_SPAN,
        lambda s: A.sessions(s, "ts", "12 hours", ["user_id"], _measures()),
    ).windows


@section.query(
    "stream_late_rows",
    f"SELECT event_type, COUNT(*) AS n, CAST(SUM({EXACT}) AS DOUBLE) AS amount FROM events GROUP BY event_type",
)
def stream_late_rows(t):
    """Files in disorder and little patience: the windows and the late rows together hold every event."""
    path = scratch_path(t.spark, "disorder")
    t.events.repartition(6, "user_id").write.parquet(path)
    daily = lambda s: A.tumbling(s, "ts", "1 day", ["event_type"], {"n": F.count(F.lit(1)), "cents": F.sum(units("value"))})
    run = feeds.run_windowed(t.spark, path, "ts", "1 hour", daily, files_per_batch=1)
    late = run.late.select("event_type", F.lit(1).cast("bigint").alias("n"), units("value").alias("cents"))
    both = run.windows.select("event_type", "n", "cents").unionByName(late).groupBy("event_type")
    return both.agg(F.sum("n").alias("n"), (F.sum("cents") / 100).alias("amount"))


@section.query(
    "stream_dedup", "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events"
)
def stream_dedup(t):
    """Which of the copies in one batch passes is open, so the keys are compared."""
    feed = event_stream(t).withColumn("day", F.to_date("ts"))
    kept = tables.first_of_copies(feed, "ts", WHOLE_SPAN, ["user_id", "day", "event_type"])
    return kept.rows.select("user_id", "day", "event_type")


NEWEST = """SELECT user_id, day, event_type, event_id, ts FROM (SELECT *, CAST(ts AS DATE) AS day, ROW_NUMBER() OVER (
    PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@section.query("stream_keep_newest", NEWEST)
def stream_keep_newest(t):
    columns = ["user_id", "day", "event_type", "event_id", "ts"]
    feed = event_stream(t).withColumn("day", F.to_date("ts")).select(*columns)
    start = t.events.withColumn("day", F.to_date("ts")).select(*columns).where(F.lit(False))
    newer = F.struct("s.ts", "s.event_id") > F.struct("t.ts", "t.event_id")
    return tables.upsert_stream(feed, start, ["user_id", "day", "event_type"], newer, newest=["ts", "event_id"])


@section.query(
    "stream_merge",
    f"""SELECT COALESCE(s.p_partkey, t.p_partkey) AS p_partkey, COALESCE(s.stock_qty, t.stock_qty) AS stock_qty
        FROM ({TARGET}) t FULL JOIN ({SOURCE}) s ON s.p_partkey = t.p_partkey""",
)
def stream_merge(t):
    quantity = F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") + 5).otherwise(F.col("p_size"))
    feed = (
        feeds.stream_files(t.spark, t.file_of("part"), t.part.schema)
        .where("p_partkey % 7 <> 0")
        .select("p_partkey", quantity.alias("stock_qty"))
    )
    changed = F.col("s.stock_qty") != F.col("t.stock_qty")
    return tables.upsert_stream(feed, stock_target(t), ["p_partkey"], changed)


OPENING_CENTS = 20_000


@section.query(
    "stream_balance",
    f"""WITH RECURSIVE d AS (SELECT user_id, event_id, CAST({EXACT} * 100 AS BIGINT) AS cents, ROW_NUMBER() OVER (
              PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'purchase'),
        b AS (SELECT user_id, event_id, cents, rn, {OPENING_CENTS} >= cents AS accepted,
                     CAST(CASE WHEN {OPENING_CENTS} >= cents THEN {OPENING_CENTS} - cents ELSE {OPENING_CENTS} END AS BIGINT) AS balance
              FROM d WHERE rn = 1
              UNION ALL
              SELECT d.user_id, d.event_id, d.cents, d.rn, b.balance >= d.cents,
                     CASE WHEN b.balance >= d.cents THEN b.balance - d.cents ELSE b.balance END
              FROM b JOIN d ON d.user_id = b.user_id AND d.rn = b.rn + 1)
        SELECT user_id AS account_id, event_id AS entry_id, cents AS amount_cents, accepted, balance AS balance_cents FROM b""",
)
def stream_balance(t):
    debits = event_stream(t).where("event_type = 'purchase'").select(
        F.col("user_id").alias("account_id"),
        F.col("event_id").alias("entry_id"),
        F.col("ts").alias("at"),
        units("value").alias("amount_cents"),
    )
    return debit_stream(debits, OPENING_CENTS, WHOLE_SPAN).decisions


@section.query(
    "stream_quarantine",
    """SELECT event_id, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS verdict, reasons FROM (
         SELECT event_id, concat_ws(';', CASE WHEN NOT value >= 1 THEN 'check(value)' END,
                CASE WHEN user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'foreign_key(user_id)' END)
                AS reasons FROM events)""",
)
def stream_quarantine(t):
    rules = [
        R.Key(("event_id",), primary=True),
        R.Check("value", "value >= 1"),
        R.Reference(("user_id",), t.customer.where("c_acctbal >= 0"), ("c_custkey",)),
    ]
    checked = tables.quarantine_stream(event_stream(t).select("event_id", "user_id", "value"), rules)
    return checked.select("event_id", "verdict", F.array_join("reasons", ";").alias("reasons"))
