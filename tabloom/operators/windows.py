"""Window patterns: aggregates beside rows, latest rows, copies, islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.operators.joins import first_per_key
from tabloom.operators.ordering import number_rows


def with_group_aggregates(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates of each group beside its rows.

    Groups are aggregated map-side and joined back, so the rows of a hot group
    stay in many tasks; a window would gather them in one.
    """
    groups = df.groupBy(*keys).agg(*aggregates)
    renamed = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *groups.columns[len(keys):])
    match = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    return df.join(renamed, match).drop(*[f"_g_{k}" for k in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key, found by an aggregation."""
    others = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max_by(F.struct(*order, *others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def mark_copies(df: DataFrame, keys: Sequence[str], newest: Sequence[str], name: str = "rn") -> DataFrame:
    """Number the copies of each key, the newest first; 1 is the row to keep."""
    return number_rows(df, [f"{c} desc" for c in newest], partition_by=keys, name=name)


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key: first day, last day, length.

    Repeated days are removed before the window, so a key has at most one row
    per calendar day.
    """
    days = df.select(key, day).distinct()
    number = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("_run", F.date_sub(day, number))
        .groupBy(key, "_run")
        .agg(
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .drop("_run")
    )


def longest_island(df: DataFrame, key: str, day: str) -> DataFrame:
    """The longest run of each key, the earliest one among equals."""
    return first_per_key(islands(df, key, day), [key], [F.col("n_days").desc(), F.col("first_day")], 1)
