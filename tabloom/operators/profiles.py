"""Profiles of tables and columns: what is in the data, how it is spread."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.ordering import running
from tabloom.session import cut_lineage


def profile_columns(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One row per column: type, rows, NULLs, distinct values, smallest and largest value.

    Exact distinct counts scan one column at a time and combine before the
    shuffle; counting all columns in one aggregation would multiply every row by
    the number of columns. ``exact_distinct=False`` counts in the single pass.
    """
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(fields):
        c = F.col(field.name)
        aggregates += [
            F.count(c).alias(f"v{i}"),
            F.min(c).cast("string").alias(f"a{i}"),
            F.max(c).cast("string").alias(f"z{i}"),
            F.approx_count_distinct(c).alias(f"d{i}"),
        ]
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"v{i}")).alias("n_nulls"),
            F.col(f"d{i}").alias("n_distinct"),
            F.col(f"a{i}").alias("min_value"),
            F.col(f"z{i}").alias("max_value"),
        )
        for i, field in enumerate(fields)
    ]
    profile = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if not exact_distinct:
        return profile
    counts = [
        df.select(F.col(field.name).alias("v"))
        .where(F.col("v").isNotNull())
        .distinct()
        .agg(F.count(F.lit(1)).alias("n_distinct"))
        .select(F.lit(field.name).alias("column_name"), "n_distinct")
        for field in fields
    ]
    return (
        profile.drop("n_distinct")
        .join(F.broadcast(reduce(DataFrame.unionByName, counts)), "column_name")
        .select("column_name", "data_type", "n_rows", "n_nulls", "n_distinct", "min_value", "max_value")
    )


def column_histogram(df: DataFrame, column: str, steps: int = 200, ranges: int | None = None) -> DataFrame:
    """Steps of about equal rows: highest value, rows equal to it, rows and values below it.

    Values are counted first, so a value held by very many rows is one row of the
    ordered pass. NULL is left out.
    """
    values = cut_lineage(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = values.agg(F.sum("n")).scalar()
    placed = running(values, ["value"], totals={"up_to": "n"}, ranges=ranges).withColumn(
        "step", F.call_function("div", (F.col("up_to") - F.col("n")) * steps, rows).cast("int")
    )
    per_step = placed.groupBy("step").agg(
        F.max("value").alias("high_value"),
        F.max_by("n", "value").alias("eq_rows"),
        (F.sum("n") - F.max_by("n", "value")).alias("range_rows"),
        (F.count(F.lit(1)) - 1).alias("distinct_range_rows"),
    )
    average = F.col("range_rows") / F.nullif("distinct_range_rows", F.lit(0))
    return per_step.withColumn("avg_range_rows", F.coalesce(average, F.lit(0.0)))


def _step_bounds(histogram: DataFrame) -> list:
    """The high values in order: one per step, of which the histogram has ``steps`` at most."""
    return [r[0] for r in histogram.select("high_value").orderBy("high_value").collect()]


def _next_bound(bounds: list, value: Column, beyond: Column) -> Column:
    """The lowest bound not below ``value``, by a balanced tree of comparisons; ``beyond`` behind the last one."""
    if not bounds:
        return beyond
    middle = len(bounds) // 2
    below = _next_bound(bounds[:middle], value, F.lit(bounds[middle]))
    return F.when(value <= F.lit(bounds[middle]), below).otherwise(_next_bound(bounds[middle + 1 :], value, beyond))


def _with_next_bound(df: DataFrame, histogram: DataFrame, column: str, name: str) -> DataFrame:
    """Add the lowest high value not below the column; NULL beyond the last step."""
    kind = histogram.schema["high_value"].dataType
    return df.withColumn(name, _next_bound(_step_bounds(histogram), F.col(column), F.lit(None)).cast(kind))


def estimate_rows(histogram: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Add the rows the histogram predicts for ``column = value``."""
    placed = _with_next_bound(values, histogram, column, "_high")
    steps = histogram.select(F.col("high_value").alias("_high"), "eq_rows", "avg_range_rows")
    estimate = F.when(F.col(column) == F.col("_high"), F.col("eq_rows").cast("double")).otherwise(
        F.coalesce("avg_range_rows", F.lit(0.0))
    )
    return placed.join(F.broadcast(steps), "_high", "left").select(*values.columns, estimate.alias("estimated_rows"))


def estimate_vs_actual(histogram: DataFrame, df: DataFrame, column: str, bad_factor: float = 10.0) -> DataFrame:
    """Predicted and counted rows per value, their ratio, and a flag for bad estimates."""
    actual = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("actual_rows"))
    both = estimate_rows(histogram, actual, column)
    least_one = F.greatest("estimated_rows", F.lit(1.0))
    error = F.greatest(least_one / F.col("actual_rows"), F.col("actual_rows") / least_one)
    return both.withColumn("q_error", error).withColumn("is_bad", F.col("q_error") >= bad_factor)


def profile_drift(before: DataFrame, after: DataFrame, column: str, steps: int = 200) -> DataFrame:
    """Rows per step of the old histogram in old and new data, and how their shares moved.

    New values beyond the last step are in the row with ``high_value`` NULL.
    """
    histogram = column_histogram(before, column, steps)
    values = after.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counted = (
        _with_next_bound(values, histogram, column, "high_value")
        .groupBy("high_value")
        .agg(F.sum("n").alias("rows_after"), F.max("n").alias("largest_after"))
    )
    old = histogram.select(
        F.col("high_value").alias("_old_high"), (F.col("eq_rows") + F.col("range_rows")).alias("rows_before")
    )
    n_before = before.agg(F.count(column)).scalar()
    n_after = after.agg(F.count(column)).scalar()
    joined = counted.join(old, F.col("high_value").eqNullSafe(F.col("_old_high")), "full").select(
        F.coalesce("high_value", "_old_high").alias("high_value"),
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        F.coalesce("largest_after", F.lit(0)).alias("largest_after"),
    )
    moved = F.col("rows_after") / n_after - F.col("rows_before") / n_before
    return joined.withColumn("share_change", F.round(moved, 6))


def selectivity(df: DataFrame, column: str, prune_below: float = 0.1) -> DataFrame:
    """Rows and share per value, and whether a filter on it is worth pruning for."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.col("n_rows") / rows
    return counts.withColumn("share", share).withColumn(
        "access", F.when(share < prune_below, "pruned").otherwise("scan")
    )


def skew_report(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """Keys holding at least ``share`` of all rows."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("share", F.col("n_rows") / rows).where(F.col("share") >= share)


def type_audit(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    """How the keys of two columns of different type compare: as they are, and after a cast.

    One row: keys of each side that do not convert to the type of the other, keys
    equal as text, and keys equal only once the left side is converted.
    """
    left_type, right_type = dict(left.dtypes)[left_column], dict(right.dtypes)[right_column]
    lefts = left.select(F.col(left_column).alias("l")).where("l IS NOT NULL").distinct()
    rights = right.select(F.col(right_column).alias("r")).where("r IS NOT NULL").distinct()
    n = F.count(F.lit(1))
    as_text = lefts.join(rights, F.col("l").cast("string") == F.col("r").cast("string"), "left_semi").agg(n)
    converted = lefts.select(F.col("l").try_cast(right_type).alias("c")).where("c IS NOT NULL")
    after = converted.join(rights, F.col("c") == F.col("r"), "left_semi").agg(n)
    return lefts.agg(
        F.lit(left_type).alias("left_type"),
        F.lit(right_type).alias("right_type"),
        F.count_if(F.col("l").try_cast(right_type).isNull()).alias("left_not_convertible"),
    ).select(
        "*",
        rights.agg(F.count_if(F.col("r").try_cast(left_type).isNull())).scalar().alias("right_not_convertible"),
        as_text.scalar().alias("equal_as_text"),
        after.scalar().alias("equal_after_cast"),
    )
