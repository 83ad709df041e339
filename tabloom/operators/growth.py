"""Period growth and the revenue report built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions.amounts import from_units, sum_units
from tabloom.operators.joins import first_per_key

def percent(part: Column, whole: Column, decimal_type: str) -> Column:
    """100 * part / whole, rounded once; NULL when the whole is 0."""
    return (F.lit(100) * part / F.nullif(whole, F.lit(0))).cast(decimal_type)


def add_growth(
    df: DataFrame, keys: Sequence[str], period: str, amount: str, name: str = "growth_pct"
) -> DataFrame:
    """Percent change to the period before. ``df`` holds one row per key and period."""
    window = Window.partitionBy(*keys).orderBy(period)
    before = F.col("_before")
    return (
        df.withColumn("_before", F.lag(amount).over(window))
        .withColumn(name, percent(F.col(amount) - before, before, "decimal(10,1)"))
        .drop("_before")
    )


def growth_report(
    lines: DataFrame, group: str, period: str, product: str, amount: str, top: int, scale: int = 4
) -> DataFrame:
    """Revenue and growth per group and period, with the ``top`` products of each.

    ``amount`` is a column of whole units of ``10 ** -scale``.

    The lines are aggregated once to (group, period, product); the totals per
    period are built from that smaller table. Lines without a group or period have
    no place in the report; dropping them first keeps the plans of both uses of
    that table equal, so that Spark computes it once.
    """
    lines = lines.where(F.col(group).isNotNull() & F.col(period).isNotNull())
    # one product of one group and period: its sum fits a 64-bit integer, or ANSI mode fails loudly
    per_product = lines.groupBy(group, period, product).agg(F.sum(amount).alias("product_units"))
    per_period = per_product.groupBy(group, period).agg(sum_units("product_units", scale).alias("revenue"))
    grown = add_growth(per_period, [group], period, "revenue")
    best = first_per_key(per_product, [group, period], [F.col("product_units").desc(), F.col(product)], top)
    product_revenue = from_units("product_units", scale)
    return grown.join(best, [group, period]).select(
        group,
        period,
        F.col("revenue").cast("double").alias("revenue"),
        "growth_pct",
        product,
        product_revenue.cast("double").alias("product_revenue"),
        percent(product_revenue, F.col("revenue"), "decimal(5,1)").alias("contribution_pct"),
    )
