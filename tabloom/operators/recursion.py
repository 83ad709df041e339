"""Hierarchies walked by doubling joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.session import cut_lineage

DEFAULT_LIMIT = 100


def hierarchy(
    edges: DataFrame, node: str, parent: str, limit: int = DEFAULT_LIMIT, with_path: bool = False
) -> DataFrame:
    """Every node below the roots (parent NULL) with its level, roots being level 0.

    By doubling: every row knows an ancestor and the distance to it, and a round joins
    it with what that ancestor knows, so that the known distance doubles. A hierarchy
    of n levels takes about log2(n) rounds, each written before the next. Rows whose
    ancestors lead to a missing node or into a cycle are not below a root and are left
    out. Deeper than ``limit`` is an error, as are cycles below a root. ``with_path``
    adds the array of nodes from below the root to the node.
    """
    child = F.col(parent).isNotNull()
    path = [F.when(child, F.array(node)).otherwise(F.array().cast(f"array<{dict(edges.dtypes)[node]}>")).alias("path")]
    extra = ["path"] if with_path else []
    state = cut_lineage(
        edges.select(node, parent, F.col(parent).alias("_above"), child.cast("int").alias("level"), *(path if with_path else []))
    )
    climbing, reached = state.agg(F.count("_above"), F.count_if(F.col("_above").isNull())).first()
    while climbing:
        known = state.select(F.col(node).alias("_node"), F.col("_above").alias("_next"), F.col("level").alias("_steps"), *[F.col(c).alias("_way") for c in extra])
        moved = state.where("_above IS NOT NULL").join(known, F.col("_above") == F.col("_node")).select(
            node,
            parent,
            F.col("_next").alias("_above"),
            (F.col("level") + F.col("_steps")).alias("level"),
            *([F.concat("_way", "path").alias("path")] if with_path else []),
        )
        state = cut_lineage(state.where("_above IS NULL").unionByName(moved))
        there = F.col("_above").isNull()
        climbing, now, deepest = state.agg(F.count("_above"), F.count_if(there), F.max(F.when(there, F.col("level")))).first()
        if (deepest or 0) > limit:
            raise RecursionError(f"hierarchy is deeper than {limit} levels")
        if now == reached:  # every level holds a node, so nothing that still climbs can arrive
            break
        reached = now
    return state.where("_above IS NULL").select(node, parent, "level", *extra)


def path_level(path: Column) -> Column:
    """Depth of a path; the root is the empty path."""
    return F.size(path)


def path_ancestor(path: Column, steps: int) -> Column:
    """The path ``steps`` levels up, NULL above the root."""
    left = F.size(path) - steps
    return F.when(left >= 0, F.slice(path, F.lit(1), F.greatest(left, F.lit(0))))


def path_is_below(path: Column, other: Column) -> Column:
    """True when ``other`` is on the way from the root to ``path``, itself included."""
    fits = F.size(path) >= F.size(other)
    return fits & (F.slice(path, F.lit(1), F.least(F.size(other), F.size(path))) == other)
