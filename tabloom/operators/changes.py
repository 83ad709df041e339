"""Table changes as pure functions: (target, source) to the new state and the changed rows.

Nothing is written here; ``tabloom.sources.snapshots`` publishes a new state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.joins import require_unique
from tabloom.operators.ordering import among_first
from tabloom.operators.windows import latest_per_key, mark_copies


class Change(NamedTuple):
    state: DataFrame
    output: DataFrame


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k] == right[k] for k in keys]


def align(rows: DataFrame, target: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows with the target's columns; only columns the rows lack get their default."""
    defaults = dict(defaults or {})
    columns = []
    for field in target.schema.fields:
        if field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = defaults.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def insert_rows(target: DataFrame, rows: DataFrame, defaults: Mapping[str, Column] | None = None) -> Change:
    added = align(rows, target, defaults)
    return Change(target.unionByName(added), added)


def insert_missing(
    target: DataFrame, source: DataFrame, keys: Sequence[str], defaults: Mapping[str, Column] | None = None
) -> Change:
    """Insert the source rows whose key the target does not hold."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return insert_rows(target, fresh, defaults)


def _before_after(changed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    pairs = []
    for c in columns:
        pairs += [F.col(c).alias(f"old_{c}"), F.col(f"_new_{c}").alias(f"new_{c}")]
    return changed.select(*keys, *pairs)


def update_where(
    target: DataFrame, keys: Sequence[str], condition: Column, assignments: Mapping[str, Column]
) -> Change:
    """UPDATE ... WHERE; the output holds keys and old and new values of the changed rows."""
    hit = F.coalesce(condition, F.lit(False))
    types = dict(target.dtypes)
    marked = target.withColumn("_hit", hit)
    for c, value in assignments.items():
        marked = marked.withColumn(f"_new_{c}", F.when(F.col("_hit"), value).cast(types[c]))
    state = marked.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in target.columns
        ]
    )
    return Change(state, _before_after(marked.where("_hit"), keys, list(assignments)))


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], assignments: Mapping[str, str]
) -> Change:
    """UPDATE ... FROM: ``assignments`` maps target columns to source columns.

    A match is known by the key, not by the values, so a source NULL is taken
    over. A key occurring twice in the source is an error.
    """
    types = dict(target.dtypes)
    require_unique(source, keys)
    side = source.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(s).cast(types[c]).alias(f"_new_{c}") for c, s in assignments.items()],
        F.lit(True).alias("_hit"),
    )
    joined = target.join(side, [F.col(k) == F.col(f"_k_{k}") for k in keys], "left")
    state = joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in target.columns
        ]
    )
    return Change(state, _before_after(joined.where("_hit"), keys, list(assignments)))


def update_first(
    target: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, assignments: Mapping[str, Column]
) -> Change:
    """UPDATE of the first ``n`` rows of an order that makes rows unique."""
    return update_where(target, keys, among_first(target, order, n), assignments)


def delete_where(target: DataFrame, condition: Column) -> Change:
    """DELETE ... WHERE; rows for which the condition is NULL stay."""
    hit = F.coalesce(condition, F.lit(False))
    return Change(target.where(~hit), target.where(hit))


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Change:
    """DELETE the target rows whose key the source holds."""
    wanted = source.select(*keys)
    return Change(
        target.join(wanted, list(keys), "left_anti"), target.join(wanted, list(keys), "left_semi")
    )


def delete_copies(target: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> Change:
    """Keep the newest row of each key; the output holds the removed copies."""
    removed = mark_copies(target, keys, newest, name="_rn").where("_rn > 1").drop("_rn")
    return Change(latest_per_key(target, keys, newest), removed)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    changed: Column | None = None,
    delete_unmatched: bool = False,
    source_is_unique: bool = False,
) -> Change:
    """MERGE with update, insert and, if asked for, delete of rows the source lacks.

    Expressions name target columns as ``t.x`` and source columns as ``s.x``.
    ``changed`` limits the update; when it is NULL the row is kept. The output has
    the action, and the key of the row after and before the change. A source key
    that occurs twice is an error; the check is a job of its own that
    ``source_is_unique`` saves.
    """
    if not source_is_unique:
        require_unique(source, keys)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")

    in_target = F.coalesce(F.col("t._in_target"), F.lit(False))
    in_source = F.coalesce(F.col("s._in_source"), F.lit(False))
    differs = F.lit(True) if changed is None else F.coalesce(changed, F.lit(False))
    action = (
        F.when(in_target & in_source & differs, "UPDATE")
        .when(~in_target, "INSERT")
        .when(~in_source & F.lit(delete_unmatched), "DELETE")
        .otherwise("KEEP")
    )
    columns = []
    for field in target.schema.fields:
        c = field.name
        value = (
            F.when(F.col("_action") == "INSERT", insert[c] if c in insert else F.lit(None))
            .when(F.col("_action") == "UPDATE", update[c] if c in update else F.col(f"t.{c}"))
            .otherwise(F.col(f"t.{c}"))
        )
        columns.append(value.cast(field.dataType).alias(c))
    acted = both.withColumn("_action", action)
    state = acted.where("_action <> 'DELETE'").select(*columns)
    log = acted.where("_action <> 'KEEP'").select(
        F.col("_action").alias("merge_action"),
        *[F.when(in_source, F.col(f"s.{k}")).alias(f"inserted_{k}") for k in keys],
        *[F.col(f"t.{k}").alias(f"deleted_{k}") for k in keys],
    )
    return Change(state, log)
