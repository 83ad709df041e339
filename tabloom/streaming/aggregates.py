"""Event-time windows over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _flat(df: DataFrame, window: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.select(
        F.col(f"{window}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{window}.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        *measures,
    )


def tumbling(stream: DataFrame, time: str, width: str, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Totals per window of fixed width."""
    return sliding(stream, time, width, width, keys, measures)


def sliding(
    stream: DataFrame, time: str, width: str, every: str, keys: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """Totals per window of fixed width that starts anew with every step."""
    grouped = stream.groupBy(F.window(time, width, every).alias("_window"), *keys)
    totals = grouped.agg(*[c.alias(n) for n, c in measures.items()])
    return _flat(totals, "_window", keys, list(measures))


def sessions(stream: DataFrame, time: str, gap: str, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Totals per run of rows that follow each other within the gap."""
    grouped = stream.groupBy(F.session_window(time, gap).alias("_session"), *keys)
    totals = grouped.agg(*[c.alias(n) for n, c in measures.items()])
    return _flat(totals, "_session", keys, list(measures))
