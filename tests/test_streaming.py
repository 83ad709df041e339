"""Streams in several batches against the batch operators."""

from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions.amounts import units
from tabloom.operators import rules as R
from tabloom.operators.changes import delete_copies
from tabloom.session import scratch_path
from tabloom.streaming import aggregates as A, balances, feeds, tables as ST
from tabloom.streaming.balances import debit_stream

MEASURES = {"n": lambda: F.count(F.lit(1)), "top": lambda: F.max("value")}


@pytest.fixture(scope="module")
def events(spark, tables):
    """The events cut into six files in order of time."""
    path = scratch_path(spark, "events")
    for part in range(6):
        tables.events.where(f"day(ts) div 5.2 = {part}").coalesce(1).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == tables.events.count()
    return path


def measures():
    return {n: f() for n, f in MEASURES.items()}




@pytest.mark.parametrize(
    "form,transform",
    [
        ("tumbling", lambda s: A.tumbling(s, "ts", "1 day", ["event_type"], measures())),
        ("sliding", lambda s: A.sliding(s, "ts", "3 days", "1 day", ["event_type"], measures())),
        ("sessions", lambda s: A.sessions(s, "ts", "12 hours", ["user_id"], measures())),
    ],
)
def test_windows_equal_batch(spark, tables, events, same, form, transform):
    run = feeds.run_windowed(spark, events, "ts", "31 days", transform, files_per_batch=1)
    assert run.late.count() == 0
    same(run.windows, transform(tables.events.withColumn("ts", F.col("ts").cast("timestamp"))))


def test_late_rows_are_set_aside(spark, values):
    path = scratch_path(spark, "late")
    for day in ("2024-01-01", "2024-01-20", "2024-01-21", "2024-01-02", None):
        values("day string, value double", (day, 1.0)).select(
            F.col("day").cast("timestamp_ntz").alias("ts"), "value"
        ).coalesce(1).write.mode("append").parquet(path)
    day = lambda s: A.tumbling(s, "ts", "1 day", [], measures())
    run = feeds.run_windowed(spark, path, "ts", "2 days", day, files_per_batch=1)
    assert run.windows.agg(F.sum("n")).first()[0] == 3 and [str(r.ts) for r in run.late.collect()] == ["2024-01-02 00:00:00"]
    patient = feeds.run_windowed(spark, path, "ts", "31 days", day, files_per_batch=1)
    assert patient.windows.agg(F.sum("n")).first()[0] == 4 and patient.late.count() == 0


@pytest.fixture(scope="module")
def disorder(spark, tables):
    """The events cut into five files that each span the month."""
    path = scratch_path(spark, "disorder")
    for part in range(5):
        tables.events.where(f"pmod(hash(user_id, event_id), 5) = {part}").coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files", [1, 2, 5])
@pytest.mark.parametrize("lateness", ["31 days", "5 days"])
def test_disorder_loses_nothing(spark, tables, disorder, same, files, lateness):
    daily = lambda s: A.tumbling(s, "ts", "1 day", ["event_type"], measures())
    run = feeds.run_windowed(spark, disorder, "ts", lateness, daily, files_per_batch=files)
    events = tables.events
    same(run.windows, daily(events.join(run.late.select("event_id"), "event_id", "left_anti").withColumn("ts", F.col("ts").cast("timestamp"))))
    n_late = run.late.count()
    assert n_late == 0 if files == 5 or lateness == "31 days" else n_late > 0
    assert run.windows.agg(F.sum("n")).first()[0] + n_late == events.count()


def keyed(df):
    return df.withColumn("day", F.to_date("ts")).select("user_id", "day", "event_type", "event_id", "ts")


def test_first_of_copies(spark, tables, events):
    feed = keyed(feeds.stream_files(spark, events, tables.events.schema, files_per_batch=1))
    kept = ST.first_of_copies(feed, "ts", "31 days", ["user_id", "day", "event_type"])
    keys = keyed(tables.events).select("user_id", "day", "event_type").distinct().count()
    assert kept.late.count() == 0
    kept = kept.rows
    assert kept.count() == kept.select("user_id", "day", "event_type").distinct().count() == keys


def test_keep_newest_equals_batch(spark, tables, events, same):
    feed = keyed(feeds.stream_files(spark, events, tables.events.schema, files_per_batch=1))
    newer = F.struct("s.ts", "s.event_id") > F.struct("t.ts", "t.event_id")
    key = ["user_id", "day", "event_type"]
    start = keyed(tables.events).where(F.lit(False))
    final = ST.upsert_stream(feed, start, key, newer, newest=["ts", "event_id"])
    same(final, delete_copies(keyed(tables.events), key, ["ts", "event_id"]).state)


def test_quarantine_equals_batch(spark, tables, events):
    rules = [R.Check("value", "value >= 1"), R.Reference(("user_id",), tables.customer.where("c_acctbal >= 0"), ("c_custkey",))]
    feed = feeds.stream_files(spark, events, tables.events.schema, files_per_batch=1)
    checked = ST.quarantine_stream(feed, rules)
    split = R.split_by_rules(tables.events, rules)
    counts = {r.verdict: r["count"] for r in checked.groupBy("verdict").count().collect()}
    assert counts == {"accepted": split.accepted.count(), "rejected": split.rejected.count()}


def test_a_repeated_batch_changes_nothing(spark):
    """The same batch id handed over twice, as after a failure."""
    path = scratch_path(spark, "twice")
    spark.range(4).select("id", F.lit(1).alias("x")).write.parquet(f"{path}/in")
    start = spark.range(2).select("id", F.lit(0).alias("x"))
    runs = []

    original = ST.run_batches

    def twice(stream, handle, progress):
        def again(batch, batch_id):
            runs.append(batch_id)
            handle(batch, batch_id)
            handle(batch, batch_id)

        original(stream, again, progress)

    ST.run_batches = twice
    try:
        schema = spark.read.parquet(f"{path}/in").schema
        final = ST.upsert_stream(feeds.stream_files(spark, f"{path}/in", schema), start, ["id"], F.col("s.x") != F.col("t.x"))
    finally:
        ST.run_batches = original
    assert runs and sorted((r.id, r.x) for r in final.collect()) == [(0, 1), (1, 1), (2, 1), (3, 1)]


def purchases(df):
    return df.where("event_type = 'purchase'").select(
        F.col("user_id").alias("account_id"), F.col("event_id").alias("entry_id"), F.col("ts").alias("at"), units("value").alias("amount_cents")
    )


@pytest.mark.parametrize("order,files", [("events", 1), ("disorder", 1), ("disorder", 3)])
def test_balances_do_not_depend_on_batches(spark, tables, request, order, files):
    feed = feeds.stream_files(spark, request.getfixturevalue(order), tables.events.schema, files_per_batch=files)
    done = debit_stream(purchases(feed), 20_000, "31 days")
    decided = {r.entry_id: (r.accepted, r.balance_cents) for r in done.decisions.collect()}
    balance, expected = {}, {}
    for r in purchases(tables.events).orderBy("at", "entry_id").collect():
        left = balance.get(r.account_id, 20_000)
        accepted = left >= r.amount_cents
        balance[r.account_id] = left - r.amount_cents if accepted else left
        expected[r.entry_id] = (accepted, balance[r.account_id])
    assert decided == expected and done.late.count() == 0
    assert any(not a for a, _ in expected.values())


def test_late_debits_are_counted(spark, tables, disorder):
    feed = feeds.stream_files(spark, disorder, tables.events.schema, files_per_batch=1)
    done = debit_stream(purchases(feed), 20_000, "5 days")
    late = done.late.count()
    assert late > 0 and done.decisions.count() + late == purchases(tables.events).count()


@pytest.mark.parametrize("remember,accepted", [(None, 6), (1, 7)])
def test_a_key_is_accepted_once_over_batches(spark, values, remember, accepted):
    path = scratch_path(spark, "keys")
    for rows in ([(1, "a"), (2, "b"), (2, "c")], [(1, "d"), (3, "e"), (None, "n")], [(4, "f"), (3, "g")], [(5, "h"), (1, "i"), (6, "j")]):
        values("id int, x string", *rows).coalesce(1).write.mode("append").parquet(path)
    feed = feeds.stream_files(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    rows = ST.quarantine_stream(feed, [R.Key(("id",), primary=True)], remember=remember).collect()
    assert len(rows) == 11 and sum(r.verdict == "accepted" for r in rows) == accepted
    assert all(list(r.reasons) == ([] if r.verdict == "accepted" else ["primary_key(id)"]) for r in rows)


class _ListState:
    def __init__(self):
        self.rows = []

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getListState(self, name, schema):
        return self.states.setdefault(name, _ListState())

    def registerTimer(self, at):
        self.timers.append(at)


def test_accounts_of_a_bucket_are_decided_in_one_call():
    """Four accounts of one bucket, and a row without account; ids beyond a double stay exact."""
    big = 2**53 + 1
    rows = [(big, 1000, big, 60), (7, 3000, 2, 30), (big, 2000, 3, 60), (8, 1000, 4, 101), (9, 9_000_000, 5, 1), (0, 0, 0, 0)]
    chunk = pd.DataFrame(rows, columns=list(balances.WAITING)).assign(known=[True] * 5 + [False])
    handle, debits = _Handle(), balances.Debits(100)
    debits.init(handle)
    assert list(debits.handleInputRows((1,), iter([chunk]), None)) == [] and handle.timers == [2]
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 5)
    (out,) = debits.handleExpiredTimer((1,), now, None)
    decided = {(r.account_id, r.entry_id): (r.accepted, r.balance_cents) for r in out.itertuples()}
    assert decided == {(big, big): (True, 40), (big, 3): (False, 40), (7, 2): (True, 70), (8, 4): (False, 100)}
    assert handle.states["waiting"].rows == [(9, 9_000_000, 5, 1)] and handle.timers == [2, 9001]
    assert dict(handle.states["balances"].rows) == {big: 40, 7: 70, 8: 100}


def test_balances_leave_rows_without_account_out(spark, values):
    path = scratch_path(spark, "debits")
    rows = [(1, 1, "2024-01-01", 60), (None, 2, "2024-01-01", 5), (2, None, "2024-01-02", 5), (1, 3, "2024-01-03", 60), (2**60 + 1, 2**60 + 3, "2024-01-03", 1)]
    values("account_id bigint, entry_id bigint, at string, amount_cents bigint", *rows).withColumn("at", F.col("at").cast("timestamp_ntz")).coalesce(1).write.parquet(path)
    done = debit_stream(feeds.stream_files(spark, path, spark.read.parquet(path).schema), 100, "31 days")
    found = sorted(tuple(r) for r in done.decisions.collect())
    assert found == [(1, 1, 60, True, 40), (1, 3, 60, False, 40), (2**60 + 1, 2**60 + 3, 1, True, 99)]
