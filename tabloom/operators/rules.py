"""Table rules (keys, references, checks) as data-quality jobs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.ordering import number_rows
from tabloom.session import stored

REASONS = "_reasons"
NUMERIC = re.compile(r"tinyint|smallint|int|bigint|float|double|decimal")


@dataclass(frozen=True)
class NotNull:
    column: str

    def broken(self, types: Mapping[str, str]) -> Column:
        return F.col(self.column).isNull()

    @property
    def reason(self) -> str:
        return f"not_null({self.column})"


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int

    def broken(self, types: Mapping[str, str]) -> Column:
        return F.length(self.column) > self.length

    @property
    def reason(self) -> str:
        return f"max_length({self.column})"


@dataclass(frozen=True)
class FitsType:
    """The value converts to the type, for example decimal(7,2); NULL passes.

    Numbers are compared with the largest value of a decimal type: a failing cast
    costs an exception per row.
    """

    column: str
    type: str

    def broken(self, types: Mapping[str, str]) -> Column:
        value = F.col(self.column)
        decimal = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", self.type)
        if decimal and NUMERIC.match(types[self.column]):
            precision, scale = (int(x) for x in decimal.groups())
            return F.abs(F.round(value, scale)) >= F.lit(10 ** (precision - scale))
        return value.isNotNull() & value.try_cast(self.type).isNull()

    @property
    def reason(self) -> str:
        return f"type({self.column})"


@dataclass(frozen=True)
class Check:
    """Broken only when the condition is FALSE; NULL passes."""

    name: str
    condition: str

    def broken(self, types: Mapping[str, str]) -> Column:
        return ~F.expr(self.condition)

    @property
    def reason(self) -> str:
        return f"check({self.name})"


@dataclass(frozen=True)
class Key:
    """Primary or unique key. ``order`` decides which copy is the first and stays
    (without it, the order of the other columns); it should tell all copies apart.

    A primary key refuses NULL. A unique key treats NULL as one more value, or
    ignores NULL with ``nulls_distinct``.
    """

    columns: tuple[str, ...]
    order: tuple[str, ...] = ()
    primary: bool = False
    nulls_distinct: bool = False

    @property
    def reason(self) -> str:
        return f"{'primary_key' if self.primary else 'unique'}({','.join(self.columns)})"


@dataclass(frozen=True)
class Reference:
    """Foreign key; a NULL in any of its columns passes."""

    columns: tuple[str, ...]
    parent: DataFrame = field(compare=False)
    parent_columns: tuple[str, ...]

    @property
    def reason(self) -> str:
        return f"foreign_key({','.join(self.columns)})"


ROW_RULES = (NotNull, MaxLength, FitsType, Check)


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def _any_null(columns: Sequence[str]) -> Column:
    result = F.lit(False)
    for c in columns:
        result = result | F.col(c).isNull()
    return result


def with_reasons(df: DataFrame, rules: Sequence) -> DataFrame:
    """Add the array of broken rules to every row.

    Row rules are one pass. A key rule numbers the copies with even ranges, so a
    key with very many copies is not gathered in one task; a reference is a left
    join with the distinct parent keys.
    """
    types = dict(df.dtypes)
    marked = df.withColumn(
        REASONS,
        F.array_compact(
            F.array(*[F.when(F.coalesce(r.broken(types), F.lit(False)), r.reason) for r in rules if isinstance(r, ROW_RULES)])
        ).cast("array<string>"),
    )

    def add(condition: Column, reason: str) -> Column:
        return F.when(condition, F.array_append(REASONS, F.lit(reason))).otherwise(F.col(REASONS))

    for rule in rules:
        if isinstance(rule, Key):
            others = list(rule.order) or [c for c in df.columns if c not in rule.columns]
            # the number of the row tells full repeats apart, also in a table of key columns only
            told = marked.withColumn("_row", F.monotonically_increasing_id())
            marked = number_rows(told, [*others, "_row"], partition_by=rule.columns, name="_copy").drop("_row")
            null_key = _any_null(rule.columns)
            repeated = F.col("_copy") > 1
            if rule.primary:
                broken = null_key | repeated
            elif rule.nulls_distinct:
                broken = ~null_key & repeated
            else:
                broken = repeated
            marked = marked.withColumn(REASONS, add(broken, rule.reason)).drop("_copy")
        elif isinstance(rule, Reference):
            parents = rule.parent.select(
                *[F.col(p).alias(f"_p_{c}") for c, p in zip(rule.columns, rule.parent_columns)]
            ).distinct()
            match = [F.col(c) == F.col(f"_p_{c}") for c in rule.columns]
            joined = marked.join(parents.withColumn("_known", F.lit(True)), match, "left")
            broken = F.col("_known").isNull() & ~_any_null(rule.columns)
            marked = joined.withColumn(REASONS, add(broken, rule.reason)).select(*df.columns, REASONS)
    return marked


def split_by_rules(df: DataFrame, rules: Sequence) -> Split:
    """Accepted rows, and rejected rows with their reasons; together they are the input."""
    marked = stored(with_reasons(df, rules), "ruled")  # marked and written once, read by both outputs
    return Split(
        marked.where(F.size(REASONS) == 0).drop(REASONS),
        marked.where(F.size(REASONS) > 0).withColumnRenamed(REASONS, "reasons"),
    )


def key_violations(df: DataFrame, columns: Sequence[str], primary: bool = True, nulls_distinct: bool = False) -> DataFrame:
    """Keys held by more than one row, or NULL in a primary key, with their number of rows."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    null_key = _any_null(columns)
    if primary:
        return groups.where((F.col("n_rows") > 1) | null_key)
    if nulls_distinct:
        return groups.where((F.col("n_rows") > 1) & ~null_key)
    return groups.where("n_rows > 1")


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    """Child rows whose parent does not exist."""
    match = [F.col(c) == F.col(f"_p_{c}") for c in columns]
    parents = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in zip(columns, parent_columns)])
    return child.where(~_any_null(columns)).join(parents, match, "left_anti")


def referenced(parent: DataFrame, parent_columns: Sequence[str], child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parent rows that may not be deleted because a child row points at them."""
    match = [F.col(p) == F.col(f"_c_{p}") for p in parent_columns]
    children = child.select(*[F.col(c).alias(f"_c_{p}") for c, p in zip(columns, parent_columns)])
    return parent.join(children, match, "left_semi")


def assign_ids(
    df: DataFrame, order: Sequence[str], name: str, seed: int | Column = 1, step: int = 1, ranges: int | None = None
) -> DataFrame:
    """Dense ids in the given order. ``seed`` may continue after an earlier table."""
    numbered = number_rows(df, order, name="_number", ranges=ranges)
    start = F.lit(seed) if isinstance(seed, int) else seed
    return numbered.select(
        (start.cast("bigint") + (F.col("_number") - 1) * step).alias(name), *df.columns
    )


def next_id(df: DataFrame, name: str, step: int = 1, first: int = 1) -> Column:
    """The id after the highest one in use."""
    return df.agg(F.coalesce(F.max(name) + step, F.lit(first))).scalar()


def add_columns(df: DataFrame, columns: Mapping[str, str], rows: DataFrame | None = None) -> DataFrame:
    """ALTER TABLE ADD: new nullable columns are NULL in old rows; ``rows`` may fill them."""
    for name, kind in columns.items():
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df if rows is None else df.unionByName(rows, allowMissingColumns=True)
