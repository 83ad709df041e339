"""Scalar functions with the meaning of a classic SQL dialect where Spark's differ."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


# ---- text ----

def text_length(column: str | Column) -> Column:
    """Characters, trailing blanks not counted."""
    return F.length(F.rtrim(_col(column)))


def utf16_bytes(column: str | Column) -> Column:
    """Stored size of a two-byte (national) text."""
    return F.length(F.encode(_col(column), "UTF-16LE"))


def find_text(wanted: str, column: str | Column) -> Column:
    """1-based position of the first occurrence, 0 when there is none."""
    return F.locate(wanted, _col(column))


def plus_text(*columns: str | Column) -> Column:
    """``a + b``: NULL when any part is NULL."""
    return F.concat(*[_col(c) for c in columns])


def concat_text(*columns: str | Column) -> Column:
    """``CONCAT(a, b)``: NULL parts count as empty."""
    return F.concat_ws("", *[_col(c) for c in columns])


def zero_pad(column: str | Column, width: int) -> Column:
    """The last ``width`` characters of the text with zeros in front."""
    return F.right(F.concat(F.lit("0" * width), _col(column).cast("string")), F.lit(width))


def format_amount(column: str | Column) -> Column:
    """1234.5 as '1,234.50'; use a decimal column for exact rounding."""
    return F.format_number(_col(column), 2)


def format_money(column: str | Column) -> Column:
    """US dollars: '$1,234.50', negative amounts in parentheses."""
    amount = F.round(_col(column).cast("decimal(38,4)"), 2)
    shown = F.concat(F.lit("$"), F.format_number(F.abs(amount), 2))
    return F.when(amount < 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)


def quote_name(column: str | Column) -> Column:
    """An identifier in backticks, inner backticks doubled."""
    return F.concat(F.lit("`"), F.replace(_col(column), F.lit("`"), F.lit("``")), F.lit("`"))


def lossy_ascii(column: str | Column) -> Column:
    """The text as a single-byte column would keep it: other characters become '?'."""
    return F.regexp_replace(_col(column), r"[^\x00-\x7F]", "?")


def lost_characters(column: str | Column) -> Column:
    return F.regexp_count(_col(column), F.lit(r"[^\x00-\x7F]"))


# ---- dates ----

# Formats of the date style codes.
DATE_STYLES = {101: "MM/dd/yyyy", 103: "dd/MM/yyyy", 120: "yyyy-MM-dd HH:mm:ss"}


def date_text(column: str | Column, style: int, length: int | None = None) -> Column:
    """A date as text by style code, cut to ``length`` characters."""
    text = F.date_format(_col(column), DATE_STYLES[style])
    return text if length is None else F.left(text, F.lit(length))


def date_plus(part: str, amount: int | Column, column: str | Column) -> Column:
    """Add units to a timestamp; months and years stop at the end of a short month."""
    return F.timestamp_add(part.upper(), F.lit(amount) if isinstance(amount, int) else amount, _col(column))


def milliseconds(column: str | Column) -> Column:
    """Milliseconds since the full minute; what is less than one is cut."""
    return F.floor(F.date_part(F.lit("SECOND"), _col(column)) * 1000).cast("int")


def millisecond(column: str | Column) -> Column:
    """The millisecond part of a time, 0 to 999."""
    return F.pmod(milliseconds(column), F.lit(1000))


def boundaries_between(part: str, start: str | Column, end: str | Column) -> Column:
    """How many year (month, day, ...) boundaries lie between two times.

    2023-12-31 to 2024-01-01 is one year here; Spark's own function counts whole
    units and says 0.
    """
    start, end = _col(start), _col(end)
    part = part.lower()
    if part == "year":
        return F.year(end) - F.year(start)
    if part == "quarter":
        return (F.year(end) * 4 + F.quarter(end)) - (F.year(start) * 4 + F.quarter(start))
    if part == "month":
        return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    days = F.date_diff(F.to_date(end), F.to_date(start))
    if part == "day":
        return days
    if part == "week":  # weeks begin on Sunday, as 1970-01-04 did
        week = lambda at: F.floor((F.unix_date(F.to_date(at)) + 4) / 7).cast("int")
        return week(end) - week(start)
    hours = days * 24 + F.hour(end) - F.hour(start)
    if part == "hour":
        return hours
    minutes = hours.cast("bigint") * 60 + F.minute(end) - F.minute(start)
    if part == "minute":
        return minutes
    if part == "second":
        return minutes * 60 + F.second(end) - F.second(start)
    if part == "millisecond":
        return minutes * 60_000 + milliseconds(end) - milliseconds(start)
    raise ValueError(f"unknown date part {part}")


def month_end(column: str | Column) -> Column:
    return F.last_day(_col(column))


def month_start(column: str | Column) -> Column:
    return F.make_date(F.year(_col(column)), F.month(_col(column)), F.lit(1))


def age_years(birth: str | Column, as_of: Column) -> Column:
    """Whole years; a birthday not yet reached in the year does not count."""
    birth = _col(birth)
    years = boundaries_between("year", birth, as_of)
    reached = F.to_date(F.timestamp_add("YEAR", years, birth.cast("timestamp_ntz"))) <= F.to_date(as_of)
    return years - F.when(reached, 0).otherwise(1)


# ---- numbers ----

def int_div(numerator: str | Column, denominator: str | Column) -> Column:
    """Integer division cut toward zero."""
    return F.call_function("div", _col(numerator), _col(denominator))


def is_number(column: str | Column, to: str = "int") -> Column:
    """1 when the text converts, else 0."""
    return F.when(_col(column).try_cast(to).isNotNull(), 1).otherwise(0)


def is_null(column: str | Column, replacement, column_type: str) -> Column:
    """``ISNULL(column, replacement)``: the result keeps the column's type."""
    return F.coalesce(_col(column).cast(column_type), F.lit(replacement).cast(column_type))


MONEY = "decimal(19,4)"


def money(column: str | Column) -> Column:
    return _col(column).cast(MONEY)


def money_div(numerator: str | Column, denominator: str | Column) -> Column:
    """Money divided by a number: four places are kept, the rest is cut.

    ``money_div(10, 3) * 3`` is 9.9999; exact decimals would give 10.
    """
    ten_thousandths = money(numerator) * F.lit(10000).cast("decimal(5,0)")
    quotient = int_div(ten_thousandths, _col(denominator).cast("decimal(19,4)"))
    return (quotient.cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(MONEY)
