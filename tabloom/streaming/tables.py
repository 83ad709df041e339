"""Streams that keep a table up to date: deduplication, upsert, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.changes import merge
from tabloom.operators.joins import require_unique
from tabloom.operators.rules import REASONS, Key, with_reasons
from tabloom.operators.windows import latest_per_key
from tabloom.session import scratch_path
from tabloom.sources.snapshots import SnapshotTable
from tabloom.streaming.feeds import END_OF_TIME, run_batches, run_to_end, split_late


class Kept(NamedTuple):
    rows: DataFrame
    late: DataFrame


def first_of_copies(stream: DataFrame, time: str, lateness: str, keys: Sequence[str], salts: int = 16) -> Kept:
    """One row of each key passes; its copies within ``lateness`` are dropped, whatever batch they are in.

    Rows that come later than ``lateness`` are returned apart, since the keys they
    would have to be held against are forgotten by then. Copies are dropped in two
    steps, the first over (key, salt): a key with very many copies is spread over
    ``salts`` tasks, and at most that many of its rows reach the task that decides.
    """
    feed = split_late(stream, time, lateness)

    def drop(timed: DataFrame) -> DataFrame:
        salted = timed.where(F.col(time) < F.lit(END_OF_TIME).cast("timestamp")).withColumn("_salt", F.pmod(F.xxhash64(*stream.columns), F.lit(salts)))
        few = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
        return few.dropDuplicatesWithinWatermark(list(keys)).withColumn(time, F.col(time).cast("timestamp_ntz"))

    return Kept(run_to_end(feed, drop), feed.late)


def fold_changes(
    table: SnapshotTable, changes: str, keys: Sequence[str], changed: Column, newest: Sequence[str] = ()
) -> DataFrame:
    """Merge the change files the current version does not hold yet; returns the new table.

    Version n holds the batches before n. Of several changes to a key the newest
    counts: by ``newest``, else by batch.
    """
    done = table.current_version()
    pending = table.spark.read.parquet(changes).where(F.col("batch") >= done)
    last = pending.agg(F.max("batch")).first()[0]
    if last is None:
        return table.read(done)
    state = table.read(done)
    latest = latest_per_key(pending, list(keys), [*newest, "batch"]).select(*state.columns)
    values = {c: F.col(f"s.{c}") for c in state.columns}
    merged = merge(state, latest, keys, update=values, insert=values, changed=changed, source_is_unique=True)
    return table.read(table.publish(merged.state, version=last + 1))


def upsert_stream(
    stream: DataFrame,
    start: DataFrame,
    keys: Sequence[str],
    changed: Column,
    newest: Sequence[str] = (),
) -> DataFrame:
    """Apply a feed to a table; returns the table after the feed.

    Every batch writes its own changes only, under its id, so a repeated batch
    replaces them; one merge folds them into the table, which is therefore
    rewritten once and not once per batch. ``changed`` compares ``s`` (feed) with
    ``t`` (table). Without ``newest`` a key may occur once per batch.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, "upsert")
    table = SnapshotTable(spark, f"{path}/table")
    table.publish(start, version=0)

    def keep(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, list(keys), list(newest)) if newest else require_unique(batch, list(keys))
        rows.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")

    run_batches(stream, keep, f"{path}/progress")
    return fold_changes(table, f"{path}/changes", keys, changed, newest)


def quarantine_stream(stream: DataFrame, rules: Sequence, remember: int | None = None) -> DataFrame:
    """Check every batch on arrival; accepted and rejected rows go to two folders.

    Returns both with ``verdict`` and ``reasons``. The keys of accepted rows are
    kept by batch, and a key of an earlier batch is a broken key rule in a later one;
    ``remember`` forgets keys after so many batches. A batch reads the keys of lower
    batch ids only, so a repeated batch gives the same verdicts.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, "quarantine")
    key_rules = [rule for rule in rules if isinstance(rule, Key)]

    def check(batch: DataFrame, batch_id: int) -> None:
        first = 0 if remember is None else max(0, batch_id - remember)
        seen = batch
        for n, rule in enumerate(key_rules):
            if batch_id > first:
                earlier = spark.read.parquet(*[f"{path}/keys-{n}/batch={k}" for k in range(first, batch_id)]).distinct()
                known = earlier.select(*[F.col(c).alias(f"_k_{c}") for c in rule.columns], F.lit(True).alias(f"_known_{n}"))
                match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in rule.columns]
                seen = seen.join(known, match, "left").drop(*[f"_k_{c}" for c in rule.columns])
            else:
                seen = seen.withColumn(f"_known_{n}", F.lit(None).cast("boolean"))
        marked = with_reasons(seen, rules)
        for n, rule in enumerate(key_rules):
            again = F.coalesce(F.col(f"_known_{n}"), F.lit(False)) & ~F.array_contains(REASONS, rule.reason)
            if rule.nulls_distinct and not rule.primary:
                for c in rule.columns:
                    again = again & F.col(c).isNotNull()
            marked = marked.withColumn(REASONS, F.when(again, F.array_append(REASONS, F.lit(rule.reason))).otherwise(F.col(REASONS)))
        verdict = F.when(F.size(REASONS) == 0, "accepted").otherwise("rejected")
        # one pass, one folder per verdict; a repeated batch replaces its own files
        checked = marked.drop(*[f"_known_{n}" for n in range(len(key_rules))]).withColumn("verdict", verdict).withColumnRenamed(REASONS, "reasons")
        checked.write.mode("overwrite").partitionBy("verdict").parquet(f"{path}/out/batch={batch_id}")
        for n, rule in enumerate(key_rules):
            done = spark.read.schema(checked.schema).parquet(f"{path}/out/batch={batch_id}").where("verdict = 'accepted'")
            done.select(*rule.columns).write.mode("overwrite").parquet(f"{path}/keys-{n}/batch={batch_id}")

    run_batches(stream, check, f"{path}/progress")
    return spark.read.parquet(f"{path}/out").drop("batch")
