"""Wait-for graphs: every waiter has one blocker."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.session import cut_lineage


def _followed(edges: DataFrame, waiter: str, blocker: str) -> DataFrame:
    """Follow the pointers of all nodes by doubling: log2(nodes) joins in all.

    The result has for every node the node reached (``at``), the steps taken to a
    root (``hops``), whether it ended there (``ends``), and the lowest node passed
    (``low``). Nodes that have reached their root are not joined again, so a root
    that blocks very many nodes is not a hot key of the later rounds.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    links = edges.select(F.col(waiter).alias("node"), F.col(blocker).alias("at"))
    roots = links.select(F.col("at").alias("node")).distinct().join(links, "node", "left_anti")
    state = cut_lineage(
        links.select("node", "at", one.alias("hops"), F.col("node").alias("low"), F.lit(False).alias("ends"))
        .unionByName(
            roots.select(
                "node", F.col("node").alias("at"), zero.alias("hops"), F.col("node").alias("low"), F.lit(True).alias("ends")
            )
        )
    )
    for _ in range(max(1, state.count().bit_length())):
        walking = state.where(~F.col("ends"))
        if walking.isEmpty():
            break
        onward = state.select(
            F.col("node").alias("at"),
            F.col("at").alias("_next"),
            F.col("hops").alias("_hops"),
            F.col("low").alias("_low"),
            F.col("ends").alias("_ends"),
        )
        moved = walking.join(onward, "at").select(
            "node",
            F.col("_next").alias("at"),
            (F.col("hops") + F.col("_hops")).alias("hops"),
            F.least("low", "_low").alias("low"),
            F.col("_ends").alias("ends"),
        )
        state = cut_lineage(state.where("ends").unionByName(moved))
    return state


def blocking_chains(edges: DataFrame, waiter: str, blocker: str) -> DataFrame:
    """For every waiter whose chain ends: its blocker, the root blocker and the depth."""
    followed = _followed(edges, waiter, blocker)
    reached = followed.where("ends AND hops > 0").select(
        F.col("node").alias(waiter), F.col("at").alias("root_blocker"), F.col("hops").alias("depth")
    )
    return edges.select(waiter, blocker).join(reached, waiter)


def wait_cycles(edges: DataFrame, waiter: str, blocker: str) -> DataFrame:
    """Nodes on a cycle of waits; ``cycle_id`` is the lowest node of the cycle.

    After at least as many steps as there are nodes, every walk that does not end
    stands on a cycle, and the walks started on a cycle cover all of it.
    """
    followed = _followed(edges, waiter, blocker)
    endless = followed.where("NOT ends")
    on_cycle = endless.select(F.col("at").alias("node")).distinct()
    return endless.join(on_cycle, "node").select(F.col("node").alias(waiter), F.col("low").alias("cycle_id"))


def deadlock_victims(cycles: DataFrame, costs: DataFrame, waiter: str, cost: str) -> DataFrame:
    """Members of each cycle with its size; the member that lost least work is the victim."""
    priced = cycles.join(costs.select(waiter, cost), waiter, "left").withColumn(cost, F.coalesce(cost, F.lit(0)))
    chosen = priced.groupBy("cycle_id").agg(
        F.count(F.lit(1)).alias("n_members"), F.min_by(waiter, F.struct(cost, waiter)).alias("victim")
    )
    return priced.join(chosen, "cycle_id").select(
        waiter, "cycle_id", "n_members", (F.col(waiter) == F.col("victim")).alias("is_victim")
    )
