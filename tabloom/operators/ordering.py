"""Ordered calculations that stay parallel whatever the size of a group.

A window function puts a whole window partition into one task: all rows when
there is no PARTITION BY, and the whole of a hot key when there is one. The
operators here deal the rows into ranges of (partition keys, order keys), so that
the ranges are even no matter how the keys are distributed, and write that copy
once with the number of the range and the place in it. Everything else is a scan of
two levels over the copy: calculations inside each range, and counts, sums and last
values carried from range to range through a table with one row per range.

The order keys must make every row unique; ties would be numbered arbitrarily, and
rows equal in all keys stand in one range. NULL is the lowest value, as in an
ordinary ORDER BY. Dealing samples the input before it moves it, so the input is
evaluated twice at most and must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tabloom.session import leaf_bytes, stored

#: Stored bytes of input for which one more range is made beyond the session's shuffle partitions.
RANGE_BYTES = 128 << 20
RANGE, PLACE = "_range", "_place"
#: monotonically_increasing_id() holds the number of the partition above these bits.
PLACE_BITS = 33


@dataclass(frozen=True)
class OrderKey:
    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        return F.col(self.name).desc() if self.descending else F.col(self.name).asc()


def order_keys(spec: Sequence[str]) -> list[OrderKey]:
    """``["price desc", "id"]`` as order keys."""
    keys = []
    for item in spec:
        name, _, direction = item.partition(" ")
        keys.append(OrderKey(name, direction.strip().lower() == "desc"))
    return keys


def _within(spec: Sequence[str], partition_by: Sequence[str]) -> list[OrderKey]:
    """The order keys that vary inside a group."""
    return [k for k in order_keys(spec) if k.name not in partition_by]


def _reaches(bound: Column, keys: Sequence[OrderKey]) -> Column:
    """True when a row stands at or after ``bound`` in the order of the keys."""
    if not any(k.descending for k in keys):
        return bound <= F.struct(*[F.col(k.name) for k in keys])
    result = F.lit(True)
    for key in reversed(keys):
        edge, value = bound[key.name], F.col(key.name)
        if key.descending:
            before = F.coalesce(edge > value, edge.isNotNull() & value.isNull())
        else:
            before = F.coalesce(edge < value, edge.isNull() & value.isNotNull())
        result = before | (edge.eqNullSafe(value) & result)
    return bound.isNotNull() & result


def range_count(df: DataFrame) -> int:
    """The session's shuffle partitions, or more where the stored input asks for more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-leaf_bytes(df) // RANGE_BYTES))


def _placed(df: DataFrame) -> DataFrame:
    """Add the number of the partition and the place in it."""
    at = df.select("*", F.monotonically_increasing_id().alias("_at"))
    return at.select(
        *df.columns,
        F.shiftright("_at", PLACE_BITS).cast("int").alias(RANGE),
        F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias(PLACE),
    )


def in_ranges(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """A written copy of ``df`` in even ranges of (partition keys, order keys): adds the range and the place in it.

    Ranges rise with the order; the last ones may be empty.
    """
    keys = [OrderKey(p) for p in partition_by] + _within(order_by, partition_by)
    sorts = [k.sort for k in keys]
    return stored(_placed(df.repartitionByRange(ranges or range_count(df), *sorts).sortWithinPartitions(*sorts)), "ranges")


def _offsets(copy: DataFrame) -> DataFrame:
    """(range, _before, _all): rows before each range, and rows altogether; one row per range."""
    line = Window.orderBy(RANGE)
    everything = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = copy.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(RANGE, (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"), F.sum("_n").over(everything).alias("_all"))


def _numbered(copy: DataFrame) -> DataFrame:
    """Replace range and place by ``_at``, the place among all rows from 0, and add ``_all``."""
    joined = copy.join(F.broadcast(_offsets(copy)), RANGE)  # one row per range
    return joined.withColumn("_at", F.col(PLACE) + F.col("_before")).drop(RANGE, PLACE, "_before")


def running(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    row_number: str | None = None,
    totals: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    firsts: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Row number, running totals, previous and first values of a group in one ordered pass.

    ``totals``, ``previous`` and ``firsts`` map a new column to the column it is taken from.
    """
    totals, previous, firsts = dict(totals or {}), dict(previous or {}), dict(firsts or {})
    if not _within(order_by, partition_by):
        raise ValueError("the order needs a column that is not in partition_by")
    copy = in_ranges(df, order_by, partition_by, ranges)
    if not (partition_by or totals or previous or firsts):
        number = [(F.col("_at") + 1).alias(row_number)] if row_number else []
        return _numbered(copy).select(*df.columns, *number)

    carry = _carried(copy, partition_by, totals, previous, firsts)
    here = Window.partitionBy(RANGE, *partition_by).orderBy(PLACE)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.row_number().over(here).cast("bigint").alias("_rn")]
    local += [F.sum(c).over(so_far).alias(f"_local_s_{i}") for i, c in enumerate(totals.values())]
    local += [F.lag(c).over(here).alias(f"_local_p_{i}") for i, c in enumerate(previous.values())]
    local += [F.first(c).over(so_far).alias(f"_local_f_{i}") for i, c in enumerate(firsts.values())]
    result = copy.select("*", *local).join(F.broadcast(carry), RANGE)  # one row per range
    goes_on = F.col("_open") & _part(partition_by).eqNullSafe(F.col("_open_part"))

    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_rn") + F.when(goes_on, F.col("_n")).otherwise(0)).alias(row_number))
    for i, name in enumerate(totals):
        inside, brought = F.col(f"_local_s_{i}"), F.when(goes_on, F.col(f"_s_{i}"))
        out.append(F.coalesce(inside + brought, inside, brought).alias(name))
    for i, name in enumerate(previous):
        brought = F.when(goes_on, F.col(f"_p_{i}"))
        out.append(F.when(F.col("_rn") == 1, brought).otherwise(F.col(f"_local_p_{i}")).alias(name))
    for i, name in enumerate(firsts):
        out.append(F.when(goes_on, F.col(f"_f_{i}")).otherwise(F.col(f"_local_f_{i}")).alias(name))
    return result.select(*out)


def _part(partition_by: Sequence[str]) -> Column:
    return F.struct(*partition_by) if partition_by else F.lit(0)


def _carried(copy: DataFrame, partition_by: Sequence[str], totals: Mapping[str, str], previous: Mapping[str, str], firsts: Mapping[str, str]) -> DataFrame:
    """One row per range: its first group, whether that began in an earlier range, and what it brings from there.

    Only the last group of a range can go on in the next one, so only its measures
    are taken; they are aggregated in the tasks that read the copy.
    """
    part = _part(partition_by)
    last = [F.max_by(F.col(c), PLACE).alias(f"p_{i}") for i, c in enumerate(previous.values())]
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(f"s_{i}") for i, c in enumerate(totals.values())]
    sums += [F.min_by(F.col(c), PLACE).alias(f"f_{i}") for i, c in enumerate(firsts.values())]
    edges = [F.min_by(part, PLACE).alias("first_part"), F.max_by(part, PLACE).alias("last_part")]
    if partition_by:
        ends = copy.groupBy(RANGE).agg(*edges, *last)
        tail = copy.join(F.broadcast(ends.select(RANGE, "last_part")), RANGE).where(part.eqNullSafe(F.col("last_part")))
        ends = ends.join(F.broadcast(tail.groupBy(RANGE).agg(*sums)), RANGE)
    else:
        ends = copy.groupBy(RANGE).agg(*edges, *last, *sums)
    line = Window.orderBy(RANGE)
    group = Window.partitionBy("last_part").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = ["n"] + [f"s_{i}" for i in range(len(totals))]
    upto = ends.select(
        RANGE, "first_part", "last_part",
        *[F.sum(m).over(group).alias(m) for m in added],
        *[F.first(f"f_{i}").over(group).alias(f"f_{i}") for i in range(len(firsts))],
        *[f"p_{i}" for i in range(len(previous))],
    )
    brought = added + [f"f_{i}" for i in range(len(firsts))] + [f"p_{i}" for i in range(len(previous))]
    return upto.select(
        RANGE,
        F.col("first_part").alias("_open_part"),
        F.coalesce(F.lag("last_part").over(line).eqNullSafe(F.col("first_part")), F.lit(False)).alias("_open"),
        *[F.lag(m).over(line).alias(f"_{m}") for m in brought],
    )


def framed(
    df: DataFrame,
    order_by: Sequence[str],
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    partition_by: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    ranges: int | None = None,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead.

    LAG and LEAD with offset and default, FIRST and LAST of a moving frame, moving
    sums: ``columns`` builds each from the ordered window it is given. The rows are
    dealt into blocks of equal size; every block gets the last ``before`` rows of the
    block before it and the first ``after`` rows of the one behind it, so a group may
    lie in any number of blocks.
    """
    if not _within(order_by, partition_by):
        raise ValueError("the order needs a column that is not in partition_by")
    ranges = ranges or range_count(df)
    rows = _numbered(in_ranges(df, order_by, partition_by, ranges))
    size = F.greatest(F.lit(before + after + 1).cast("bigint"), F.ceil(F.col("_all") / ranges))
    block, place = F.call_function("div", F.col("_at"), size), F.col("_at") % size
    halo = [F.when(place >= size - before, block + 1)] if before else []
    halo += [F.when((place < after) & (block > 0), block - 1)] if after else []
    spread = rows.withColumn("_own", block).withColumn("_block", F.explode(F.array_compact(F.array(block, *halo))))
    window = Window.partitionBy("_block", *partition_by).orderBy("_at")
    made = spread.select("*", *[build(window).alias(name) for name, build in columns.items()])
    return made.where(F.col("_block") == F.col("_own")).select(*df.columns, *columns)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "rn",
    **options,
) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY ... ORDER BY ...)."""
    return running(df, order_by, partition_by, row_number=name, **options)


def rank_rows(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    rank: str | None = "rank",
    dense: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """RANK and DENSE_RANK: ties are allowed and share their rank.

    The distinct keys are ranked, not the rows, so a value held by many rows is
    counted before any shuffle. Adaptive execution splits such a value when the ranks
    are joined back.
    """
    names = [*partition_by, *[k.name for k in order_keys(order_by)]]
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    ranked = running(
        counts, order_by, partition_by, row_number="_dense", totals={"_up_to": "_copies"}, ranges=ranges
    )
    side = ranked.select(*[F.col(n).alias(f"_k_{n}") for n in names], "_dense", "_up_to", "_copies")
    match = [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names]
    out = [F.col(c) for c in df.columns]
    if rank:
        out.append((F.col("_up_to") - F.col("_copies") + 1).alias(rank))
    if dense:
        out.append(F.col("_dense").alias(dense))
    return df.join(side, match, "inner").select(*out)


def tile_rows(
    df: DataFrame, tiles: Mapping[str, int], order_by: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """NTILE over all rows, one column per entry; the first rows % n tiles get one row more."""
    numbered = _numbered(in_ranges(df, order_by, ranges=ranges))
    columns = []
    for name, n in tiles.items():
        size, larger = F.call_function("div", F.col("_all"), F.lit(n)), F.col("_all") % n
        head = larger * (size + 1)
        tile = F.when(F.col("_at") < head, F.call_function("div", F.col("_at"), size + 1)).otherwise(
            larger + F.call_function("div", F.col("_at") - head, F.nullif(size, F.lit(0)))
        )
        columns.append((tile + 1).cast("int").alias(name))
    return numbered.select(*df.columns, *columns)


def first_of_tasks(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of every partition: all that can be among the first ``n`` of ``df``."""
    local = _placed(df.sortWithinPartitions(*[k.sort for k in order_keys(order_by)]))
    return local.where(F.col(PLACE) < n).drop(RANGE, PLACE)


def page(df: DataFrame, order_by: Sequence[str], offset: int, fetch: int, ranges: int | None = None) -> DataFrame:
    """OFFSET ... FETCH NEXT ... ROWS.

    Every task keeps the rows that the page or what precedes it may hold. These are
    dealt into ranges, so that no task gets the first rows of all others, and the
    counts of the ranges tell where the page lies.
    """
    kept = first_of_tasks(df, order_by, offset + fetch)
    rows = _numbered(in_ranges(kept, order_by, ranges=ranges or range_count(df)))
    return rows.where((F.col("_at") >= offset) & (F.col("_at") < offset + fetch)).select(*df.columns)


def among_first(df: DataFrame, order_by: Sequence[str], n: int) -> Column:
    """True for the first ``n`` rows of ``df``: they do not stand after the n-th row.

    Only the n-th row is looked up; the rows themselves are neither numbered nor
    shuffled.
    """
    if n <= 0:
        return F.lit(False)
    keys = order_keys(order_by)
    names = [k.name for k in keys]
    last = page(df, order_by, n - 1, 1).select(F.struct(*names).alias("_last")).scalar()
    is_last = F.lit(True)
    for name in names:
        is_last = is_last & F.col(name).eqNullSafe(last[name])
    return F.coalesce(~_reaches(last, keys) | is_last, F.lit(True))


def top_with_ties(df: DataFrame, n: int, by: str) -> DataFrame:
    """The first ``n`` rows by ``by`` descending, and every row tied with the last."""
    edge = (
        df.where(F.col(by).isNotNull())
        .select(by)
        .orderBy(F.col(by).desc())
        .limit(n)
        .agg(F.min(by))
    )
    return df.where(F.col(by) >= edge.scalar())
