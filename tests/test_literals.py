"""Small literal tables with known results."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import Window, functions as F

from tabloom.functions import predicates as P, routines, scalars as S, xml
from tabloom.operators import aggregates as A, changes as C, joins as J, recursion as R, rules, windows as W
from tabloom.operators.growth import add_growth
from tabloom.operators.ledger import post_batch

D = decimal.Decimal


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def date(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture
def left_right(values):
    left = values("id int, l string", (1, "L-only"), (2, "Both-A"), (3, "Both-B"))
    right = values("id int, r string", (2, "Both-A"), (3, "Both-B"), (4, "R-only"))
    return left, right


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_join_kinds(left_right):
    left, right = left_right
    assert ids(left.join(right, "id")) == [2, 3]
    assert ids(left.join(right, "id", "left")) == [1, 2, 3]
    assert ids(left.join(right, "id", "right")) == [2, 3, 4]
    assert ids(left.join(right, "id", "full")) == [1, 2, 3, 4]
    assert left.crossJoin(right).count() == 9
    assert ids(left.select("id").subtract(right.select("id"))) == [1]
    assert ids(left.select("id").intersect(right.select("id"))) == [2, 3]
    assert left.select("id").union(right.select("id")).count() == 6
    assert left.select("id").union(right.select("id")).distinct().count() == 4


def test_filter_in_on_or_where(left_right):
    left, right = left_right
    on = left.join(right, (left.id == right.id) & (right.r == "Both-A"), "left")
    where = left.join(right, left.id == right.id, "left").where(right.r == "Both-A")
    assert (on.count(), where.count()) == (3, 1)


def test_not_in_and_null(values):
    df = values("k int", (1,), (2,), (None,))
    keys = lambda *rows: values("k2 int", *rows)
    got = lambda other: sorted((r.k for r in J.not_in(df, "k", other, "k2").collect()), key=str)
    assert got(keys((2,))) == [1]
    assert got(keys((2,), (None,))) == []
    assert got(keys().where("k2 = 1")) == [1, 2, None]


def test_join_many_to_one_refuses_copies(values):
    many, one_ = values("k int, x int", (1, 1), (1, 2)), values("k int, y int", (1, 5), (1, 6))
    with pytest.raises(ValueError, match="not unique"):
        J.join_many_to_one(many, one_, ["k"])
    assert J.join_many_to_one(many, one_.limit(1), ["k"]).count() == 2


def test_salted_join_equals_join(spark, same):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    big = big.withColumn("k", F.when(F.col("id") % 7 != 0, F.col("k")))
    for how in ("inner", "left", "left_semi", "left_anti"):
        same(J.salted_join(big, small, "k", how=how), big.join(small, "k", how))
    with pytest.raises(ValueError):
        J.salted_join(big, small, "k", how="full")


def test_text_functions(spark):
    assert one(spark, S.text_length(F.lit("ab  "))) == 2
    assert one(spark, S.utf16_bytes(F.lit("Café"))) == 8
    assert one(spark, S.find_text("l", F.lit("hello"))) == 3
    assert one(spark, S.find_text("z", F.lit("hello"))) == 0
    assert one(spark, F.substring(F.lit("hello"), 2, 3)) == "ell"
    assert one(spark, S.plus_text(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, S.concat_text(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert one(spark, S.zero_pad(F.lit(42), 10)) == "0000000042"
    assert one(spark, S.zero_pad(F.lit(12345), 3)) == "345"
    assert one(spark, S.quote_name(F.lit("a`b"))) == "`a``b`"
    assert one(spark, S.lossy_ascii(F.lit("Café 正"))) == "Caf? ?"
    assert one(spark, S.lost_characters(F.lit("Café 正"))) == 2


def test_amounts_as_text(spark):
    money = lambda text: one(spark, S.format_money(F.lit(text).cast("decimal(10,4)")))
    assert one(spark, S.format_amount(F.lit("1234.5").cast("decimal(10,2)"))) == "1,234.50"
    assert money("1234.5") == "$1,234.50"
    assert money("-1234.5") == "($1,234.50)"
    assert money("0.005") == "$0.01"
    assert money("-0.001") == "$0.00"


def test_boundaries_between(spark):
    n = lambda part, a, b: one(spark, S.boundaries_between(part, date(a), date(b)))
    assert n("year", "2023-12-31", "2024-01-01") == 1
    assert n("quarter", "2023-12-31", "2024-01-01") == 1
    assert n("month", "2024-01-31", "2024-02-01") == 1
    assert n("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00") == 1
    assert n("hour", "2024-01-01 23:59:59", "2024-01-02 00:00:00") == 1
    assert n("minute", "2024-01-01 00:00:59", "2024-01-01 00:02:00") == 2
    assert n("second", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.0") == 1
    assert n("millisecond", "2024-01-01 00:00:00.9999", "2024-01-01 00:00:01.0") == 1
    assert n("millisecond", "2024-01-02 00:00:00", "2024-01-01 23:59:59.9985") == -2
    assert n("millisecond", "1900-01-01", "2024-01-01") == 45_290 * 86_400_000
    assert n("week", "2024-01-06 23:59:59", "2024-01-07") == 1 and n("week", "2024-01-07", "2024-01-13") == 0
    assert n("week", "1969-12-28", "1969-12-27") == -1 and n("week", "1969-12-28", "1970-01-03") == 0
    assert one(spark, S.millisecond(date("2024-01-01 10:20:30.4567"))) == 456
    assert n("year", "2024-01-01", "2023-12-31") == -1
    with pytest.raises(ValueError):
        S.boundaries_between("century", date("2024-01-01"), date("2024-01-01"))


def test_dates(spark):
    assert one(spark, S.date_plus("month", 1, date("2024-01-31"))) == dt.datetime(2024, 2, 29)
    assert one(spark, S.month_end(date("2024-02-10"))) == dt.date(2024, 2, 29)
    assert one(spark, S.month_start(date("2024-02-10"))) == dt.date(2024, 2, 1)
    assert one(spark, S.date_text(date("2024-02-10 13:05:09"), 120)) == "2024-02-10 13:05:09"
    assert one(spark, S.date_text(date("2024-02-10"), 103, 10)) == "10/02/2024"
    assert one(spark, S.date_text(date("2024-02-10"), 101, 10)) == "02/10/2024"
    age = lambda a, b: one(spark, S.age_years(date(a), date(b)))
    assert age("1990-06-15", "2024-06-14") == 33
    assert age("1990-06-15", "2024-06-15") == 34


def test_numbers(spark):
    assert one(spark, F.lit("3.7").cast("decimal(3,1)").cast("int")) == 3
    assert one(spark, S.int_div(F.lit(-7), F.lit(2))) == -3
    assert one(spark, S.is_number(F.lit("12"))) == 1
    assert one(spark, S.is_number(F.lit("A001"))) == 0
    third = S.money_div(F.lit(10), F.lit(3))
    assert one(spark, third) == D("3.3333")
    assert one(spark, S.money(third * 3)) == D("9.9999")
    assert one(spark, S.money_div(F.lit(20), F.lit(3))) == D("6.6666")
    assert one(spark, S.money_div(F.lit(-20), F.lit(3))) == D("-6.6666")


def test_typed_comparison_of_dirty_text(values):
    df = values("code string", ("A001",), ("0042",), ("42",), (None,))
    assert df.where(P.equals_number("code", 42)).count() == 2
    assert df.where(P.equals_typed("code", 42, "string")).count() == 1


def test_day_range_and_between(values):
    df = values("s string", ("2024-01-10 00:00:00",), ("2024-01-10 15:00:00",), ("2024-01-11 00:00:00",)).select(
        F.col("s").cast("timestamp_ntz").alias("ts")
    )
    assert df.where(P.between_dates("ts", "2024-01-05", "2024-01-10")).count() == 1
    assert df.where(P.day_range("ts", "2024-01-05", "2024-01-10")).count() == 2


def test_words(values):
    df = values("t string", ("The cat, sat.",), ("catalog",), (None,))
    assert df.where(P.has_word("t", "CAT")).count() == 1
    assert df.where(P.has_any_word("t", ["dog", "catalog"])).count() == 1


def test_integer_average_and_ratio(values):
    df = values("x int", (1,), (2,), (2,), (None,))
    assert df.agg(A.avg_int("x")).first()[0] == 1
    assert df.where("x > 5").agg(A.avg_int("x")).first()[0] is None
    assert one(df.sparkSession, A.safe_ratio(F.lit(1.0), F.lit(0))) is None


def test_unpivot_nulls(values):
    df = values("id int, a int, b int", (1, 10, None))
    assert A.unpivot(df, ["id"], ["a", "b"]).count() == 1
    assert A.unpivot(df, ["id"], ["a", "b"], include_nulls=True).count() == 2


def test_text_list(values):
    df = values("g int, s string", (1, "b"), (1, "a"), (1, "b"), (2, None))
    assert {r.g: r.t for r in A.text_list(df, ["g"], "s", "t").collect()} == {1: "a, b", 2: ""}


MONTHLY = {
    "North": [12000, 15000, 11000, 18000, 16500, 19000],
    "South": [8000, 9500, 10200, 11000, 12400, 13100],
}


@pytest.fixture
def monthly(values):
    rows = [(2023, m + 1, region, D(x)) for region, xs in MONTHLY.items() for m, x in enumerate(xs)]
    return values("year int, month int, region string, revenue decimal(14,2)", *rows)


def test_growth(monthly):
    north = add_growth(monthly, ["region"], "month", "revenue").where("region = 'North'").orderBy("month").collect()
    assert [r.growth_pct for r in north[:3]] == [None, D("25.0"), D("-26.7")]


def test_moving_average_and_running_sum(monthly):
    window = Window.partitionBy("region").orderBy("month")
    rows = monthly.select(
        "region", "month", F.avg("revenue").over(window.rowsBetween(-2, 0)).alias("m"),
        F.sum("revenue").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
    ).where("region = 'South' AND month = 6").collect()
    assert rows[0].s == D(64200) and abs(float(rows[0].m) - 36500 / 3) < 0.01


VISITS = {1: [1, 2, 3, 6, 7], 2: [1, 3, 4, 5, 10], 3: [2, 3, 4, 5, 6, 7]}


def test_islands(values):
    rows = [(m, dt.date(2026, 3, d)) for m, days in VISITS.items() for d in days]
    visits = values("member int, day date", *rows, rows[0])
    first = [
        (r.first_day.day, r.last_day.day, r.n_days)
        for r in W.islands(visits, "member", "day").where("member = 1").orderBy("first_day").collect()
    ]
    assert first == [(1, 3, 3), (6, 7, 2)]
    longest = {r.member: (r.first_day.day, r.last_day.day, r.n_days) for r in W.longest_island(visits, "member", "day").collect()}
    assert longest == {1: (1, 3, 3), 2: (3, 5, 3), 3: (2, 7, 6)}


@pytest.fixture
def resent(values):
    base = [(i, f"p{i}@x", dt.date(2026, 1, 15)) for i in range(1, 51)]
    again = [(50 + n, f"p{i}@x", dt.date(2026, 2, 20)) for n, i in enumerate(range(3, 51, 3), 1)]
    return values("id int, email string, loaded date", *base, *again)


def test_deduplicate_keeps_newest(resent):
    assert resent.count() == 66
    change = C.delete_copies(resent, ["email"], ["loaded", "id"])
    check = A.duplicate_check(change.state, ["email"]).first()
    assert (check.n_rows, check.n_keys) == (50, 50)
    assert change.output.count() == 16
    assert change.state.where("email = 'p3@x'").first().loaded == dt.date(2026, 2, 20)


@pytest.fixture
def stock(values):
    target = values("product_id int, qty int", (1, 100), (2, 200), (3, 300))
    source = values("product_id int, qty int", (1, 95), (3, 310), (4, 50), (5, 0))
    return target, source


def merge(target, source, **options):
    values_ = {"product_id": F.col("s.product_id"), "qty": F.col("s.qty")}
    return C.merge(target, source, ["product_id"], {"qty": F.col("s.qty")}, values_, F.col("s.qty") != F.col("t.qty"), **options)


def test_merge(stock):
    change = merge(*stock, delete_unmatched=True)
    assert {(r.product_id, r.qty) for r in change.state.collect()} == {(1, 95), (3, 310), (4, 50), (5, 0)}
    log = {(r.merge_action, r.inserted_product_id, r.deleted_product_id) for r in change.output.collect()}
    assert log == {("UPDATE", 1, 1), ("UPDATE", 3, 3), ("INSERT", 4, None), ("INSERT", 5, None), ("DELETE", None, 2)}
    assert (2, 200) in {(r.product_id, r.qty) for r in merge(*stock).state.collect()}


def test_merge_refuses_source_copies(stock, values):
    with pytest.raises(ValueError, match="not unique"):
        merge(stock[0], values("product_id int, qty int", (1, 1), (1, 2)))


def test_merge_comparison_with_null_keeps_the_row(values):
    target, source = values("product_id int, qty int", (1, None)), values("product_id int, qty int", (1, 5))
    assert merge(target, source).state.first().qty is None


def test_update_from_takes_over_null(values):
    target, source = values("k int, x int", (1, 1), (2, 2)), values("k int, x int", (1, None))
    change = C.update_from(target, source, ["k"], {"x": "x"})
    assert {(r.k, r.x) for r in change.state.collect()} == {(1, None), (2, 2)}
    assert [(r.old_x, r.new_x) for r in change.output.collect()] == [(1, None)]


def test_update_and_delete_leave_unknown_rows(values):
    df = values("k int, x int", (1, 1), (2, None))
    assert {(r.k, r.x) for r in C.update_where(df, ["k"], F.col("x") > 0, {"x": F.col("x") * 2}).state.collect()} == {(1, 2), (2, None)}
    assert [r.k for r in C.delete_where(df, F.col("x") > 0).state.collect()] == [2]


def test_insert_defaults_only_fill_missing_columns(values):
    target = values("k int, x int, y string", (1, 1, "a"))
    added = C.insert_rows(target, values("k int, x int", (2, None)), {"x": F.lit(9), "y": F.lit("d")}).output.first()
    assert (added.k, added.x, added.y) == (2, None, "d")
    again = C.insert_missing(target, values("k int, x int", (1, 5), (3, 5)), ["k"]).state
    assert sorted(r.k for r in again.collect()) == [1, 3]


@pytest.fixture
def accounts(values):
    return values(
        "account_id int, owner string, balance decimal(14,2)",
        (1, "Alice", D(1000)), (2, "Bob", D(500)), (3, "Carol", D(250)),
    )


def post(accounts, values, *rows):
    transfers = values("from_id int, to_id int, amount decimal(14,2)", *[(a, b, D(x)) for a, b, x in rows])
    return post_batch(accounts, transfers, "b1", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_transfers(accounts, values):
    refused = post(accounts, values, (1, 2, 5000))
    assert {r.account_id: r.balance for r in refused.state.collect()} == {1: D(1000), 2: D(500), 3: D(250)}
    assert [r.reason for r in refused.reasons.collect()] == ["insufficient balance"]
    assert refused.log.count() == 0
    done = post(accounts, values, (1, 2, 50), (2, 3, 10))
    assert {r.account_id: r.balance for r in done.state.collect()} == {1: D(950), 2: D(540), 3: D(260)}
    assert done.log.first().n_transfers == 2
    assert [r.reason for r in post(accounts, values, (1, 9, 5)).reasons.collect()] == ["unknown account"]


def test_rules_reject_and_go_on(values):
    departments = values("id int, name string, budget decimal(14,2)", (1, "Engineering", D(5)), (2, "Marketing", D(2)),
                         (3, "Engineering", D(1)), (4, None, D(1)), (5, None, D(-1)), (6, "Sales", None))
    split = rules.split_by_rules(
        departments, [rules.Check("budget", "budget >= 0"), rules.Key(("name",), order=("id",))]
    )
    assert ids(split.accepted) == [1, 2, 4, 6]
    assert {r.id: r.reasons for r in split.rejected.collect()} == {
        3: ["unique(name)"], 5: ["check(budget)", "unique(name)"],
    }
    loose = rules.split_by_rules(departments, [rules.Key(("name",), order=("id",), nulls_distinct=True)])
    assert ids(loose.rejected) == [3]
    primary = rules.split_by_rules(departments, [rules.Key(("name",), order=("id",), primary=True)])
    assert ids(primary.rejected) == [3, 4, 5]
    staff = values("id int, department int", (1, 1), (2, 999), (3, None))
    assert ids(rules.split_by_rules(staff, [rules.Reference(("department",), departments, ("id",))]).rejected) == [2]
    assert ids(rules.orphans(staff, ["department"], departments, ["id"])) == [2]
    assert ids(rules.referenced(departments, ["id"], staff, ["department"])) == [1]


def test_row_rules(values):
    df = values("id int, s string, x double", (1, "abc", 1.0), (2, None, 99999.999), (3, "abcdef", None))
    checks = [rules.NotNull("s"), rules.MaxLength("s", 4), rules.FitsType("x", "decimal(7,2)")]
    assert {r.id: r.reasons for r in rules.split_by_rules(df, checks).rejected.collect()} == {
        2: ["not_null(s)", "type(x)"], 3: ["max_length(s)"],
    }
    text = values("id int, s string", (1, "12.5"), (2, "x"), (3, "123456"))
    assert ids(rules.split_by_rules(text, [rules.FitsType("s", "decimal(5,2)")]).rejected) == [2, 3]


def test_ids(values):
    df = values("name string", ("b",), ("a",), ("c",))
    numbered = rules.assign_ids(df, ["name"], "id", seed=1000, step=5)
    assert {r.name: r.id for r in numbered.collect()} == {"a": 1000, "b": 1005, "c": 1010}
    more = rules.assign_ids(df, ["name"], "id", seed=rules.next_id(numbered, "id"))
    assert sorted(r.id for r in more.collect()) == [1011, 1012, 1013]


def test_hierarchy(values):
    edges = values("node int, parent int", (1, None), (2, 1), (3, 1), (4, 3), (9, 8))
    tree = {r.node: (r.level, r.path) for r in R.hierarchy(edges, "node", "parent", with_path=True).collect()}
    assert tree == {1: (0, []), 2: (1, [2]), 3: (1, [3]), 4: (2, [3, 4])}
    with pytest.raises(RecursionError):
        R.hierarchy(edges, "node", "parent", limit=1)
    loop = values("node int, parent int", (1, None), (2, 1), (2, 2))
    with pytest.raises(RecursionError):
        R.hierarchy(loop, "node", "parent", limit=5)


def test_paths(spark):
    path = F.array(F.lit(3), F.lit(4))
    assert one(spark, R.path_level(path)) == 2
    assert one(spark, R.path_ancestor(path, 1)) == [3]
    assert one(spark, R.path_ancestor(path, 3)) is None
    assert one(spark, R.path_is_below(path, F.array(F.lit(3))))
    assert not one(spark, R.path_is_below(F.array(F.lit(3)), path))


def test_recursion_limit_of_sql(spark):
    text = "WITH RECURSIVE n(c) {} AS (SELECT 1 UNION ALL SELECT c + 1 FROM n WHERE c < 150) SELECT max(c) AS m FROM n"
    assert spark.sql(text.format("MAX RECURSION LEVEL 200")).first().m == 150
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        spark.sql(text.format("")).collect()


def test_errors(values):
    df = values("x int", (1,), (-1,), (None,))
    with pytest.raises(routines.DataError) as caught:
        routines.require(df, F.col("x") >= 0, 50001, "Insufficient balance")
    assert (caught.value.number, caught.value.message) == (50001, "Insufficient balance")
    assert routines.require(df, F.col("x") < 5, 50001, "too large") is df
    with pytest.raises(Exception, match="negative x"):
        df.select(routines.raise_for_row(F.col("x") >= 0, "negative x", F.col("x"))).collect()
    quotients = df.select(*routines.safe_divide(F.lit(1.0), F.col("x") + 1, "q", "e")).collect()
    assert [(r.q, r.e) for r in quotients] == [(0.5, None), (None, "DIVIDE_BY_ZERO"), (None, None)]


def test_xml_escapes(spark):
    df = spark.range(1).select(
        "id", F.concat(F.lit("<r>"), xml.element("e", {"t": F.lit('a<"&')}), F.lit("</r>")).alias("body")
    )
    assert xml.shred(df, "body", "e", {"t": "string"}).first().t == 'a<"&'


@pytest.mark.parametrize("with_path", [False, True])
def test_deep_chain_takes_few_rounds(spark, values, monkeypatch, with_path):
    """90 levels, a second tree, a node without its parent, and a cycle that hangs below no root."""
    rounds = []
    keep = R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: rounds.append(1) or keep(df))
    chain = [(0, None)] + [(i, i - 1) for i in range(1, 91)] + [(200, None), (201, 200), (300, 999), (400, 401), (401, 400), (402, 401)]
    found = R.hierarchy(values("id int, up int", *chain), "id", "up", with_path=with_path)
    rows = {r.id: r for r in found.collect()}
    assert {i: r.level for i, r in rows.items()} == {**{i: i for i in range(91)}, 200: 0, 201: 1}
    assert len(rounds) <= 9
    if with_path:
        assert rows[90].path == list(range(1, 91)) and rows[0].path == [] and rows[201].path == [201]


def test_several_parents_give_several_ways(values):
    edges = values("id int, up int", (1, None), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4))
    found = R.hierarchy(edges, "id", "up", with_path=True)
    assert sorted((r.id, tuple(r.path)) for r in found.collect()) == [(1, ()), (2, (2,)), (3, (3,)), (4, (2, 4)), (4, (3, 4)), (5, (2, 4, 5)), (5, (3, 4, 5))]


def test_key_rules_on_a_table_of_key_columns(values):
    rows = values("a int, b string", (1, "x"), (1, "x"), (1, "x"), (2, "y"), (None, "z"))
    split = rules.split_by_rules(rows, [rules.Key(("a", "b"), primary=True)])
    assert sorted(map(tuple, split.accepted.collect())) == [(1, "x"), (2, "y")] and split.rejected.count() == 3


def test_a_large_side_is_not_broadcast(spark):
    small = spark.range(2)
    large = spark.range(10_000)
    assert J.join_with(large, small, large.id == small.id, "broadcast").count() == 2
    with pytest.raises(ValueError, match="limit is 1000"):
        J.join_with(small, large, large.id == small.id, "broadcast", broadcast_limit=1000)
    assert J.join_with(small, large, large.id == small.id, "merge", broadcast_limit=1000).count() == 2
