"""Predicates written so that the comparison reaches the parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _midnight(day: str | dt.date) -> Column:
    return F.lit(str(day)).cast("timestamp_ntz")


def day_range(column: str | Column, first: str | dt.date, last: str | dt.date) -> Column:
    """Every moment from ``first`` 00:00 to the end of the day ``last``."""
    after = dt.date.fromisoformat(str(last)) + dt.timedelta(days=1)
    return (_col(column) >= _midnight(first)) & (_col(column) < _midnight(after))


def between_dates(column: str | Column, first: str | dt.date, last: str | dt.date) -> Column:
    """Inclusive BETWEEN on two dates: a time part on the last day is cut off at 00:00."""
    return _col(column).between(_midnight(first), _midnight(last))


def in_year(column: str | Column, year: int) -> Column:
    """``YEAR(column) = year`` as a range; Spark does not push the function form down."""
    return (_col(column) >= _midnight(dt.date(year, 1, 1))) & (
        _col(column) < _midnight(dt.date(year + 1, 1, 1))
    )


def in_month(column: str | Column, month: str) -> Column:
    """``month`` is 'yyyy-MM'."""
    year, number = (int(x) for x in month.split("-"))
    after = dt.date(year + number // 12, number % 12 + 1, 1)
    return (_col(column) >= _midnight(dt.date(year, number, 1))) & (_col(column) < _midnight(after))


def equals_or_null(column: str | Column, value) -> Column:
    """``ISNULL(column, value) = value`` without a function around the column."""
    return (_col(column) == F.lit(value)) | _col(column).isNull()


def equals_typed(column: str | Column, value, column_type: str) -> Column:
    """Compare with the literal cast to the column's type, so the column is never converted."""
    return _col(column) == F.lit(value).cast(column_type)


def equals_number(column: str | Column, value: int) -> Column:
    """Compare a dirty text column with a number; text that is no number does not match."""
    return _col(column).try_cast("bigint") == F.lit(value)


def words(column: str | Column) -> Column:
    """Lower-case words of a text."""
    return F.split(F.lower(_col(column)), r"\W+")


def has_word(column: str | Column, word: str) -> Column:
    return F.array_contains(words(column), word.lower())


def has_any_word(column: str | Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(words(column), F.array(*[F.lit(w.lower()) for w in wanted]))
