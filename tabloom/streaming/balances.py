"""Account balances kept as stream state; a debit beyond the balance is refused."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tabloom.session import setting
from tabloom.streaming.feeds import run_to_end, split_late

RESULT = "account_id bigint, entry_id bigint, amount_cents bigint, accepted boolean, balance_cents bigint"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Pandas counts nanoseconds and ends here.
LAST_IN_PANDAS = "2262-04-01 00:00:00"
#: Accounts are dealt to so many buckets, each with a state of its own.
BUCKETS = 1024
WAITING = ("account_id", "at_us", "entry_id", "amount_cents")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Debits(StatefulProcessor):
    """Debits wait in state until no earlier one can come, and are then decided in order of (at, entry_id) per account.

    A key is a bucket of accounts: state is read and written once per bucket, not once per account.
    """

    def __init__(self, opening_cents: int):
        self.opening = opening_cents

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.balances = handle.getListState("balances", "account_id bigint, cents bigint")
        self.waiting = handle.getListState("waiting", "account_id bigint, at bigint, entry_id bigint, amount_cents bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for chunk in rows:
            chunk = chunk[chunk["known"].to_numpy(bool)]
            if chunk.empty:
                continue
            self.waiting.appendList(list(zip(*(chunk[c].astype("int64").tolist() for c in WAITING))))
            lowest = int(chunk["at_us"].min())
            first = lowest if first is None else min(first, lowest)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.waiting.get())
        ready = sorted(r for r in held if r[1] < passed)
        if not ready:
            return
        balances = dict(self.balances.get())
        accepted, after = np.zeros(len(ready), bool), np.zeros(len(ready), np.int64)
        for i, (account, _, _, debit) in enumerate(ready):
            balance = balances.get(account, self.opening)
            if balance >= debit:
                balance -= debit
                accepted[i] = True
            balances[account] = after[i] = balance
        self.balances.put(list(balances.items()))
        rest = [r for r in held if r[1] >= passed]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(r[1] for r in rest) // 1000 + 1)
        else:
            self.waiting.clear()
        yield pd.DataFrame(
            {
                "account_id": np.array([r[0] for r in ready], np.int64),
                "entry_id": [r[2] for r in ready],
                "amount_cents": [r[3] for r in ready],
                "accepted": accepted,
                "balance_cents": after,
            }
        )

    def close(self) -> None:
        pass


class Decided(NamedTuple):
    decisions: DataFrame
    late: DataFrame


def debit_stream(entries: DataFrame, opening_cents: int, lateness: str, files_per_batch: int | None = None) -> Decided:
    """Decide debits (account_id, entry_id, at, amount_cents) of a feed in order of (at, entry_id) per account.

    A debit waits until the watermark has passed it, so the decisions do not depend
    on how the feed is cut into batches or in which order its files come. Debits
    that come more than ``lateness`` behind the newest one are not decided but
    returned as ``late``; debits without account are left out. The debits of one bucket
    of accounts within the reach of lateness are held and decided by one task.
    """
    spark = entries.sparkSession
    feed = split_late(entries, "at", lateness)

    def decide(rows: DataFrame) -> DataFrame:
        # a filter on the account would keep the row at the end of time from the watermark
        known = F.col("account_id").isNotNull() & F.col("entry_id").isNotNull()
        whole = [F.when(known, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("account_id", "entry_id", "amount_cents")]
        bucket = F.pmod(F.xxhash64("account_id"), F.lit(BUCKETS)).alias("bucket")
        timed = rows.select(bucket, known.alias("known"), "at", F.unix_micros("at").alias("at_us"), *whole)
        return timed.groupBy("bucket").transformWithStateInPandas(Debits(opening_cents), RESULT, "append", "eventTime")

    with setting(spark, STATE_STORE, ROCKSDB):
        return Decided(run_to_end(feed, decide, files_per_batch=files_per_batch, end_of_time=LAST_IN_PANDAS), feed.late)
