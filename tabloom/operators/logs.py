"""Reports over log tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.aggregates import safe_int_ratio


def top_consumers(
    log: DataFrame, key: str, amount: Column, top: int, ignore: Sequence[str] = (), by_average: bool = False
) -> DataFrame:
    """Total, count and whole-number average of an amount per key, the largest first."""
    kept = log.where(~F.col(key).isin(*ignore)) if ignore else log
    totals = kept.groupBy(key).agg(F.sum(amount).alias("total"), F.count(F.lit(1)).alias("n"))
    ranked = totals.withColumn("average", safe_int_ratio(F.col("total"), F.col("n")))
    return ranked.orderBy(F.col("average" if by_average else "total").desc(), key).limit(top)


def counter_growth(before: DataFrame, after: DataFrame, keys: Sequence[str], counter: str) -> DataFrame:
    """Growth of cumulative counters between two snapshots.

    A counter that went down was restarted: its growth is its new value. A key
    only in the first snapshot has not grown.
    """
    old = before.select(*keys, F.col(counter).alias("_old"))
    new = after.select(*keys, F.col(counter).alias("_new"))
    joined = old.join(new, list(keys), "full")
    was, now = F.coalesce("_old", F.lit(0)), F.coalesce("_new", F.lit(0))
    restarted = F.col("_old").isNotNull() & F.col("_new").isNotNull() & (now < was)
    growth = F.when(F.col("_new").isNull(), 0).when(restarted, now).otherwise(now - was)
    return joined.select(*keys, growth.alias("growth"), restarted.alias("restarted"))
