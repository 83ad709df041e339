"""Range-split ordering against plain windows, with hot keys, ties and NULLs."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tabloom.operators import ordering as O
from tabloom.session import setting


def skewed(spark, rows=4000):
    """Half of the rows in one group, a third with one price, some NULLs."""
    i = F.col("id")
    return spark.range(rows).select(
        i,
        F.when(i % 2 == 0, 7).otherwise(i % 13).alias("grp"),
        F.when(i % 3 == 0, F.lit("100.00")).when(i % 11 == 0, None).otherwise((i * 37 % 500).cast("string"))
        .cast("decimal(10,2)").alias("price"),
        F.when(i % 17 == 0, None).otherwise(F.concat(F.lit("n"), (i * 31 % 97).cast("string"))).alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i * 7 % 50).cast("int")).alias("day"),
        (i * 0.37).alias("weight"),
    )


ORDERS = [
    ["price", "id"],
    ["price desc", "id"],
    ["name", "id desc"],
    ["day desc", "name desc", "id desc"],
    ["weight", "id"],
]


@pytest.mark.parametrize("partition", [(), ("grp",), ("grp", "name")])
@pytest.mark.parametrize("order", ORDERS)
def test_running_equals_plain_window(spark, same, partition, order):
    df = skewed(spark)
    keys = O.order_keys(order)
    window = Window.partitionBy(*partition).orderBy(*[k.sort for k in keys])
    found = O.running(df, order, partition, "rn", {"total": "price"}, {"before": "day"}, {"start": "name"}, ranges=9)
    plain = df.withColumn("rn", F.row_number().over(window)).withColumn(
        "total", F.sum("price").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("before", F.lag("day").over(window)).withColumn("start", F.first("name").over(window))
    same(found, plain)


@pytest.mark.parametrize("order", [["x", "id"], ["x desc", "id"]])
def test_extreme_doubles(spark, same, order):
    """NaN is the greatest double, NULL the lowest value; integers may exceed a double's precision."""
    i = F.col("id")
    special = F.element_at(
        F.array(*[F.lit(v).cast("double") for v in (float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5)]),
        (i % 6 + 1).cast("int"),
    )
    df = spark.range(700).select(i, F.when(i % 7 == 0, None).when(i % 5 == 0, i * 1.0).otherwise(special).alias("x"))
    window = Window.orderBy(*[k.sort for k in O.order_keys(order)])
    same(O.number_rows(df, order, ranges=9), df.withColumn("rn", F.row_number().over(window)))
    big = spark.range(500).select(i, (F.lit(2**53) + i / 4).cast("bigint").alias("x"))
    same(O.number_rows(big, order, ranges=9), big.withColumn("rn", F.row_number().over(window)))


def test_naive_times_across_a_clock_change(spark, same):
    """2024-03-10 02:00 to 03:00 does not exist in New York; naive times do not care."""
    start = F.lit("2024-03-10 00:30:00").cast("timestamp_ntz")
    with setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        df = spark.range(300).select("id", F.timestamp_add("SECOND", F.col("id") * 53, start).alias("x"))
        window = Window.orderBy("x", "id")
        same(O.number_rows(df, ["x", "id"], ranges=20), df.withColumn("rn", F.row_number().over(window)))


FRAMES = {
    "two_back": lambda w: F.lag("price", 2, Decimal("0.00")).over(w),
    "three_ahead": lambda w: F.lead("day", 3).over(w),
    "from": lambda w: F.first("name").over(w.rowsBetween(-2, 3)),
    "to": lambda w: F.last("name").over(w.rowsBetween(-2, 3)),
    "moving": lambda w: F.sum("price").over(w.rowsBetween(-2, 0)),
    "centred": lambda w: F.count("price").over(w.rowsBetween(-1, 1)),
}


@pytest.mark.parametrize("partition", [(), ("grp",), ("grp", "name")])
@pytest.mark.parametrize("order", [ORDERS[1], ORDERS[3]])
def test_frames_equal_plain_window(spark, same, partition, order):
    df = skewed(spark)
    window = Window.partitionBy(*partition).orderBy(*[k.sort for k in O.order_keys(order)])
    found = O.framed(df, order, FRAMES, partition, before=2, after=3, ranges=9)
    same(found, df.select("*", *[build(window).alias(name) for name, build in FRAMES.items()]))


@pytest.mark.parametrize("rows,ranges", [(0, 3), (1, 5), (7, 7), (23, 40)])
def test_frames_wider_than_a_range(spark, same, rows, ranges):
    df = skewed(spark, rows)
    window = Window.orderBy("day", "id")
    wide = {"x": lambda w: F.lag("id", 5).over(w), "y": lambda w: F.sum("id").over(w.rowsBetween(-5, 4))}
    same(O.framed(df, ["day", "id"], wide, before=5, after=4, ranges=ranges), df.select("*", *[b(window).alias(n) for n, b in wide.items()]))


@pytest.mark.parametrize("kind", ["binary", "boolean", "float", "tinyint", "decimal(38,10)", "timestamp", "timestamp_ntz", "date", "array<int>", "struct<a:int,b:string>"])
@pytest.mark.parametrize("direction", ["", " desc"])
def test_order_keys_of_any_type(spark, same, kind, direction):
    i = F.col("id")
    small = F.when(i % 7 == 0, None).otherwise(i * 31 % 90)
    key = {
        "binary": small.cast("string").cast("binary"), "boolean": small % 2 == 0, "float": (small / 3).cast("float"), "tinyint": small.cast("tinyint"),
        "decimal(38,10)": small.cast("decimal(38,10)") / 7, "timestamp": F.timestamp_micros(small), "timestamp_ntz": F.timestamp_micros(small).cast("timestamp_ntz"),
        "date": F.date_add(F.lit("1999-12-31").cast("date"), small.cast("int")), "array<int>": F.array(small.cast("int"), (i % 3).cast("int")), "struct<a:int,b:string>": F.struct(small.cast("int").alias("a"), (i % 3).cast("string").alias("b")),
    }[kind]
    df = spark.range(500).select("id", key.cast(kind).alias("x"))
    order = [f"x{direction}", "id"]
    window = Window.orderBy(*[k.sort for k in O.order_keys(order)])
    same(O.running(df, order, row_number="rn", previous={"p": "id"}, ranges=7), df.withColumn("rn", F.row_number().over(window)).withColumn("p", F.lag("id").over(window)))


@pytest.mark.parametrize("partition", [(), ("grp",)])
@pytest.mark.parametrize("order", [["price desc"], ["name"], ["day", "price desc"]])
def test_ranks_with_ties(spark, same, partition, order):
    df = skewed(spark)
    window = Window.partitionBy(*partition).orderBy(*[k.sort for k in O.order_keys(order)])
    found = O.rank_rows(df, order, partition, "r", "d", ranges=7)
    same(found, df.withColumn("r", F.rank().over(window)).withColumn("d", F.dense_rank().over(window)))


@pytest.mark.parametrize("tiles", [1, 4, 7, 50])
def test_tiles(spark, same, tiles):
    df = skewed(spark, 41)
    found = O.tile_rows(df, {"t": tiles}, ["price desc", "id"], ranges=5)
    same(found, df.withColumn("t", F.ntile(tiles).over(Window.orderBy(F.col("price").desc(), "id"))))


@pytest.mark.parametrize("offset,fetch", [(0, 5), (1999, 3), (3990, 100), (5000, 10)])
def test_pages(spark, same, offset, fetch):
    df = skewed(spark).select("id", "price")
    plain = df.orderBy(F.col("price").desc(), "id").offset(offset).limit(fetch)
    same(O.page(df, ["price desc", "id"], offset, fetch, ranges=6), plain)
    same(O.page(df, ["price desc", "id"], offset, fetch), plain)


@pytest.mark.parametrize("n", [0, 1, 700, 4000, 9999])
def test_among_first(spark, same, n):
    df = skewed(spark).select("id", "price")
    same(df.where(O.among_first(df, ["price desc", "id"], n)), df.orderBy(F.col("price").desc(), "id").limit(n))


def test_ties_at_the_edge_are_kept(values):
    df = values("id int, x int", (1, 9), (2, 8), (3, 8), (4, 8), (5, 1), (6, None))
    assert sorted(r.id for r in O.top_with_ties(df, 2, "x").collect()) == [1, 2, 3, 4]


def test_ranges_are_even_under_a_hot_value(spark):
    """One value holds a third of the rows and one group half of them."""
    df = skewed(spark, 20_000)
    for order, partition in ((["price", "id"], ()), (["price", "id"], ("grp",))):
        sizes = [r["count"] for r in O.in_ranges(df, order, partition, ranges=8).groupBy(O.RANGE).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 4 * 20_000 / 8


def test_ranges_follow_the_order(spark):
    spread = O.in_ranges(skewed(spark), ["price desc", "name", "id"], ranges=6)
    edges = spread.groupBy(O.RANGE).agg(F.max("price").alias("high"), F.min("price").alias("low")).orderBy(O.RANGE).collect()
    for left, right in zip(edges, edges[1:]):
        assert right.high is None or left.low >= right.high


def test_detail_rows_never_meet_in_one_partition(spark):
    """Every single-partition step is fed by an aggregation to one row per range."""
    for made in (O.running(skewed(spark), ["price", "id"], totals={"s": "price"}), O.number_rows(skewed(spark), ["price", "id"]), O.framed(skewed(spark), ["id"], {"x": lambda w: F.lag("id").over(w)}, before=1)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        parts = plan.split("Exchange SinglePartition")
        assert len(parts) > 1
        for below in parts[1:]:
            assert "HashAggregate(keys=[_range" in below.split("Scan")[0] or "Aggregate(key=[_range" in below.split("Scan")[0]


def test_a_page_moves_only_rows_it_may_hold(spark):
    kept = O.first_of_tasks(skewed(spark).repartition(5), ["price desc", "id"], 30)
    assert kept.count() == 150


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=40),
    st.integers(1, 9),
)
def test_small_inputs(spark, rows, ranges):
    df = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)], "id int, g string, x int")
    found = O.running(df, ["x desc", "id"], ["g"], "rn", {"s": "x"}, ranges=ranges).collect()
    by_group = {}
    for i, (g, x) in enumerate(rows):
        by_group.setdefault(g, []).append((i, x))
    for g, members in by_group.items():
        members.sort(key=lambda m: (m[1] is None, -(m[1] or 0), m[0]))
        total = None
        for n, (i, x) in enumerate(members, 1):
            total = total if x is None else (total or 0) + x
            row = next(r for r in found if r.id == i)
            assert (row.rn, row.s) == (n, total)
    assert len(found) == len(rows)


@pytest.mark.parametrize("order", [["at", "id"], ["at desc", "id"]])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("ranges", [None, 40])
def test_timestamps_a_microsecond_apart(spark, order, zone, ranges):
    with setting(spark, "spark.sql.session.timeZone", zone):
        i = F.col("id")
        # half past one in New York, on the day when that hour occurs twice
        at = F.when(i % 97 == 0, None).otherwise(F.timestamp_micros(F.lit(1730611800000000) + i * 7919 % 2000))
        df = spark.range(2000).select("id", at.alias("at"))
        keys = O.order_keys(order)
        plain = F.row_number().over(Window.orderBy(*[k.sort for k in keys]))
        wrong = O.number_rows(df, order, ranges=ranges).withColumn("plain", plain).where("rn <> plain")
        assert wrong.count() == 0
        first = O.page(df, order, offset=700, fetch=5)
        wanted = df.orderBy(*[k.sort for k in keys]).limit(705).collect()[700:]
        assert sorted(r["id"] for r in first.collect()) == sorted(r["id"] for r in wanted)
