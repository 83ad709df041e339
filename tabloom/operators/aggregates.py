"""Aggregations with the exact meaning of a classic SQL dialect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def avg_int(column: str) -> Column:
    """Average of an integer column, cut to an integer."""
    return F.call_function("div", F.sum(column), F.nullif(F.count(column), F.lit(0)))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0))


def safe_int_ratio(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, cut toward zero; NULL when the denominator is 0."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str = "measure",
    value: str = "value",
    include_nulls: bool = False,
) -> DataFrame:
    """Columns to rows; like the UNPIVOT clause it drops NULL values unless told otherwise."""
    rows = df.unpivot(list(ids), list(values), name, value)
    return rows if include_nulls else rows.where(F.col(value).isNotNull())


def text_list(df: DataFrame, keys: Sequence[str], column: str, name: str, separator: str = ", ") -> DataFrame:
    """The distinct values of a column per key as one ordered text.

    Copies are removed before the texts of a key meet, so the group that one task
    sees is as large as its result.
    """
    return (
        df.select(*keys, column)
        .distinct()
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_list(column)), separator).alias(name))
    )


def salted_sum(df: DataFrame, key: str, measures: dict[str, Column], salts: int = 32) -> DataFrame:
    """Sums per key in two steps, the first over (key, salt).

    For plain sums Spark's own partial aggregation does the same inside each map
    task; the salt also spreads the merge of the partial sums of a hot key.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    partial = df.groupBy(key, salt.alias("_salt")).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    return partial.groupBy(key).agg(*[F.sum(n).alias(n) for n in measures])


def duplicate_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys of a table; equal numbers mean the keys are unique."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )
