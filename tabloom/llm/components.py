"""Connected components of a graph that is only ever held as a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.session import cut_lineage


def _print(edges: DataFrame) -> tuple:
    """Number and order-free checksum of a set of edges; xor cannot overflow."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(lowest.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest node reached.

    Alternates two grouped steps (hang larger neighbours on the smallest one, hang
    smaller neighbours on the smallest one) until the edges are stars. Minima are
    aggregated before the shuffle and joins on a hot node are splittable, so a hub
    with a third of all edges does not land in one task. Every round is written with
    ``checkpoint()``. NULL ends, loops and repeated edges are ignored; no edges give
    no rows.
    """
    now = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"), F.col(left).alias("a"), F.col(right).alias("b"))
    now = cut_lineage(now.where("a <> b").select("u", "v").distinct())
    before, found = None, _print(now)
    while found[0] and found != before:
        before = found
        now = cut_lineage(_small_star(_large_star(now)).distinct())
        found = _print(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
