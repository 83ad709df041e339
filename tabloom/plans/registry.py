"""Named queries: a DataFrame plan over the tables and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions.amounts import sum_amount, sum_units, units
from tabloom.sources.tables import Tables

Plan = Callable[[Tables], DataFrame]


class Section:
    """The queries of one area; ``sql`` is the same result in DuckDB's SQL."""

    def __init__(self) -> None:
        self.plans: dict[str, Plan] = {}
        self.checks: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
        def add(plan: Plan) -> Plan:
            if name in self.plans:
                raise ValueError(f"query {name} is defined twice")
            self.plans[name] = plan
            if sql is not None:
                self.checks[name] = sql
            return plan

        return add


def over_directory(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(Tables(spark, sf_dir))

    run.__name__ = plan.__name__
    return run


def cents(column: str | Column) -> Column:
    """Exact two-place amount, so that sums do not depend on the order of rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def total(column: str | Column) -> Column:
    return sum_amount(column).cast("double")


def mean(column: str | Column) -> Column:
    return total(column) / F.count(column)


def month_of(column: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.col(column) if isinstance(column, str) else column, "month")


LINE_SCALE = 4


def line_units() -> Column:
    """Exact price of an order line after discount, in ten-thousandths."""
    return units("l_extendedprice") * (F.lit(100) - units("l_discount"))


def line_total() -> Column:
    return sum_units(line_units(), LINE_SCALE)
