"""Waits, blocking, deadlocks and counters, taken from the events table as a log."""

from pyspark.sql import functions as F

from tabloom.functions.amounts import sum_amount, units
from tabloom.operators import graphs as G, logs as L
from tabloom.plans.registry import Section

section = Section()


def millis():
    return units("value")


EXACT_MILLIS = "CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)"


@section.query(
    "log_top_waits",
    f"""SELECT event_type, CAST(SUM({EXACT_MILLIS}) AS BIGINT) AS total, COUNT(*) AS n,
               CAST(SUM({EXACT_MILLIS}) AS BIGINT) // COUNT(*) AS average FROM events
        WHERE event_type NOT IN ('view') GROUP BY 1 ORDER BY total DESC, event_type LIMIT 10""",
)
def log_top_waits(t):
    return L.top_consumers(t.events, "event_type", millis(), top=10, ignore=["view"])


@section.query(
    "log_top_statements",
    """SELECT statement, CAST(SUM(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total, COUNT(*) AS n,
              CAST(SUM(CAST(trunc(value) AS BIGINT)) AS BIGINT) // COUNT(*) AS average, substring(statement, 1, 120) AS shown
       FROM (SELECT event_type || ' ' || props AS statement, value FROM events)
       WHERE statement LIKE '%k%' AND statement NOT LIKE '%error%'
       GROUP BY 1 ORDER BY average DESC, statement LIMIT 5""",
)
def log_top_statements(t):
    statement = F.concat("event_type", F.lit(" "), "props")
    log = t.events.select(statement.alias("statement"), "value").where(
        F.col("statement").like("%k%") & ~F.col("statement").like("%error%")
    )
    found = L.top_consumers(log, "statement", F.col("value").cast("bigint"), top=5, by_average=True)
    return found.withColumn("shown", F.substring("statement", 1, 120))  # filters and groups use the whole text


WAITS = """WITH RECURSIVE n AS (SELECT MAX(user_id) + 1 AS n FROM events),
    e AS (SELECT DISTINCT user_id, (user_id * 7 + 3) % n AS blocker FROM events, n WHERE user_id % 10 <> 0),
    w AS (SELECT user_id, blocker, blocker AS here, 1 AS depth, LEAST(user_id, blocker) AS low FROM e
          UNION ALL SELECT w.user_id, w.blocker, e.blocker, depth + 1, LEAST(low, e.blocker) FROM w JOIN e ON e.user_id = w.here
          WHERE depth < (SELECT n FROM n) AND w.here <> w.user_id)"""


def wait_edges(t):
    """Nine of ten users wait for one other; the rest wait for nobody."""
    n = t.events.agg(F.max("user_id") + 1).scalar()
    users = t.events.select("user_id").distinct()
    return users.where("user_id % 10 <> 0").select("user_id", ((F.col("user_id") * 7 + 3) % n).alias("blocker"))


@section.query(
    "blocking_chain",
    WAITS
    + """ SELECT user_id, blocker, here AS root_blocker, CAST(depth AS BIGINT) AS depth FROM w
          WHERE here NOT IN (SELECT user_id FROM e)""",
)
def blocking_chain(t):
    return G.blocking_chains(wait_edges(t), "user_id", "blocker")


@section.query(
    "deadlock_cycles",
    WAITS
    + """, c AS (SELECT user_id, low AS cycle_id FROM w WHERE here = user_id),
           k AS (SELECT user_id, SUM(CAST(value AS DECIMAL(18,2))) AS cost FROM events GROUP BY 1),
           m AS (SELECT c.*, COUNT(*) OVER (PARTITION BY cycle_id) AS n_members,
                        ROW_NUMBER() OVER (PARTITION BY cycle_id ORDER BY cost, c.user_id) AS rn FROM c JOIN k ON k.user_id = c.user_id)
          SELECT user_id, cycle_id, n_members, rn = 1 AS is_victim FROM m""",
)
def deadlock_cycles(t):
    costs = t.events.groupBy("user_id").agg(sum_amount("value").alias("cost"))
    cycles = G.wait_cycles(wait_edges(t), "user_id", "blocker")
    return G.deadlock_victims(cycles, costs, "user_id", "cost")


@section.query(
    "log_lock_summary",
    """SELECT l.user_id, l.event_type, n_locks, c_name FROM (
         SELECT user_id, event_type, COUNT(*) AS n_locks FROM events GROUP BY 1, 2) l
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON c_custkey = l.user_id
       ORDER BY n_locks DESC, l.user_id, l.event_type""",
)
def log_lock_summary(t):
    locks = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_locks"))
    named = t.customer.where("c_acctbal > 5000").select("c_custkey", "c_name")
    return (
        locks.join(named, F.col("c_custkey") == F.col("user_id"), "left")
        .select("user_id", "event_type", "n_locks", "c_name")
        .orderBy(F.col("n_locks").desc(), "user_id", "event_type")
    )


@section.query(
    "log_size_rollup",
    """SELECT lang, CAST(SUM(n_chars // 8192 + 1) AS BIGINT) AS n_pages,
              CAST(SUM(n_chars // 8192 + 1) * 8 / 1024.0 AS DECIMAL(12,2)) AS megabytes FROM documents GROUP BY 1""",
)
def log_size_rollup(t):
    """Texts stored in pages of 8 KB: pages and megabytes per language."""
    pages = F.sum(F.expr("n_chars div 8192") + 1)
    rolled = t.documents.groupBy("lang").agg(pages.alias("n_pages"))
    size = (F.col("n_pages") * 8).cast("decimal(20,0)") / F.lit("1024.0").cast("decimal(5,1)")
    return rolled.withColumn("megabytes", size.cast("decimal(12,2)"))


def _counter(t, until):
    """Cumulative purchases per user; every seventh user's counter restarts on the 15th."""
    day = F.to_date("ts")
    counted = (day < F.lit(until).cast("date")) & (
        (F.col("user_id") % 7 != 0) | (F.lit(until).cast("date") < F.lit("2024-01-15").cast("date"))
        | (day >= F.lit("2024-01-15").cast("date"))
    )
    events = t.events.where(F.col("event_type") == "purchase").where(counted)
    return events.groupBy("user_id").agg(F.sum(millis()).alias("spent"))


@section.query(
    "counter_diff",
    f"""WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, {EXACT_MILLIS} AS v FROM events WHERE event_type = 'purchase'),
        a AS (SELECT user_id, SUM(v) AS s FROM p WHERE day < DATE '2024-01-10' GROUP BY 1),
        b AS (SELECT user_id, SUM(v) AS s FROM p WHERE day < DATE '2024-01-20' AND (user_id % 7 <> 0 OR day >= DATE '2024-01-15')
              GROUP BY 1)
        SELECT user_id, CAST(CASE WHEN b.s IS NULL THEN 0 WHEN b.s < a.s THEN b.s ELSE b.s - COALESCE(a.s, 0) END AS BIGINT) AS growth,
               COALESCE(b.s < a.s, FALSE) AS restarted FROM a FULL JOIN b USING (user_id)""",
)
def counter_diff(t):
    return L.counter_growth(_counter(t, "2024-01-10"), _counter(t, "2024-01-20"), ["user_id"], "spent")
