"""Join forms that need more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.session import estimated_bytes

#: Bytes of a side that may be sent to every task on request.
BROADCAST_LIMIT = 256 << 20
SENT_TO_ALL = ("broadcast", "nested_loop")
STRATEGIES = {
    "broadcast": "broadcast",
    "hash": "shuffle_hash",
    "merge": "merge",
    "nested_loop": "shuffle_replicate_nl",
}


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``column NOT IN (SELECT other_column FROM other)`` with SQL's NULL rules.

    A NULL on the right empties the result; a NULL on the left passes only when
    the right side is empty. Spark's own plan for NOT IN broadcasts the right
    side whatever its size; here it is an ordinary anti join and two counts.
    """
    wanted = other.select(F.col(other_column).alias("_wanted"))
    kept = df.join(
        wanted.where(F.col("_wanted").isNotNull()), F.col(column) == F.col("_wanted"), "left_anti"
    )
    has_null = wanted.agg(F.count_if(F.col("_wanted").isNull()) > 0).scalar()
    is_empty = wanted.agg(F.count(F.lit(1)) == 0).scalar()
    return kept.where(~has_null & (F.col(column).isNotNull() | is_empty))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits each key to ``n`` rows per task before the shuffle, so a hot key
    never reaches one task whole.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def apply_first(
    outer: DataFrame,
    inner: DataFrame,
    outer_key: str,
    inner_key: str,
    order: Sequence[Column],
    n: int,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Join every outer row with its first ``n`` inner rows (CROSS APPLY, OUTER APPLY)."""
    top = first_per_key(inner, [inner_key], order, n)
    how = "left" if keep_unmatched else "inner"
    return outer.join(top, outer[outer_key] == top[inner_key], how)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error when a key occurs twice."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(3)
    found = [tuple(row)[:-1] for row in twice.collect()]
    if found:
        raise ValueError(f"{list(keys)} is not unique, for example {found}")
    return df


def join_many_to_one(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that cannot multiply the rows of ``many``: the keys of ``one`` are checked first."""
    return many.join(require_unique(one, keys), list(keys), how)


def join_with(left: DataFrame, right: DataFrame, on, strategy: str, how: str = "inner", broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join by a named strategy; without a name, adaptive execution decides.

    Strategies that send the right side to every task are refused when the optimizer
    estimates it above ``broadcast_limit`` bytes; an unknown size is above any limit.
    """
    if strategy in SENT_TO_ALL:
        size = estimated_bytes(right)
        if size > broadcast_limit:
            raise ValueError(f"{strategy} would send about {size} bytes to every task, the limit is {broadcast_limit}")
    return left.join(right.hint(STRATEGIES[strategy]), on, how)


def salted_join(
    big: DataFrame, small: DataFrame, key: str, hot_share: float = 0.05, salts: int = 32, how: str = "inner"
) -> DataFrame:
    """Equi join in which the rows of hot keys are spread over ``salts`` tasks.

    Kinds: inner, left, left_semi, left_anti; the others would show repeated rows of
    the small side. A key is hot when it holds ``hot_share`` of the big side, so there are at most
    1 / hot_share of them. Only the hot rows of the small side are repeated.
    Adaptive execution splits skewed partitions too; this form does not depend on
    its thresholds.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted {how} join")
    rows = big.agg(F.count(F.lit(1))).scalar()
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") >= rows * hot_share).select(F.col(key).alias("_hot"))
    is_hot = F.col("_hot").isNotNull()

    # at most 1 / hot_share rows
    marked_big = big.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    # NULL keys match nothing, so any salt does for them
    spread = is_hot | F.col(key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")).otherwise(0)
    spread_big = marked_big.withColumn("_salt", salt).drop("_hot")

    marked_small = small.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_small = marked_small.withColumn("_salt", F.explode(copies)).drop("_hot")
    return spread_big.join(spread_small, [key, "_salt"], how).drop("_salt")
