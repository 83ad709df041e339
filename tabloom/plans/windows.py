"""Window functions, ranking, running totals and the patterns built on them."""

from decimal import Decimal

from pyspark.sql import Window, functions as F

from tabloom.functions.amounts import sum_amount
from tabloom.operators import ordering as O, windows as W
from tabloom.operators.growth import add_growth, growth_report, percent
from tabloom.operators.joins import first_per_key
from tabloom.plans.registry import Section, cents, line_units, mean, month_of, total

section = Section()
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
MONTHS = f"""SELECT r_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, SUM({PRICE}) AS revenue
             FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey GROUP BY ALL"""
PER_REGION = "PARTITION BY r_name ORDER BY order_month NULLS FIRST"


def region_months(t):
    """One row per region and month: every window over it is bounded by the calendar."""
    return (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .groupBy("r_name", month_of("o_orderdate").alias("order_month"))
        .agg(sum_amount("o_totalprice").alias("revenue"))
    )


def per_region():
    return Window.partitionBy("r_name").orderBy("order_month")


def as_double(column, name):
    return column.cast("double").alias(name)


@section.query(
    "win_row_number",
    """SELECT p_partkey, p_type, p_retailprice,
              ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part""",
)
def win_row_number(t):
    parts = t.part.select("p_partkey", "p_type", "p_retailprice")
    return O.number_rows(parts, ["p_retailprice desc", "p_partkey"], ["p_type"])


@section.query(
    "win_rank_dense_global",
    """SELECT p_partkey, p_retailprice, RANK() OVER (ORDER BY p_retailprice DESC) AS price_rank,
              DENSE_RANK() OVER (ORDER BY p_retailprice DESC) AS dense_price_rank FROM part""",
)
def win_rank_dense_global(t):
    parts = t.part.select("p_partkey", "p_retailprice")
    return O.rank_rows(parts, ["p_retailprice desc"], rank="price_rank", dense="dense_price_rank")


@section.query(
    "win_ntile_global",
    """SELECT p_partkey, CAST(NTILE(4) OVER (ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS quartile,
              CAST(NTILE(7) OVER (ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS seventh FROM part""",
)
def win_ntile_global(t):
    parts = t.part.select("p_partkey", "p_retailprice")
    tiles = {"quartile": 4, "seventh": 7}
    return O.tile_rows(parts, tiles, ["p_retailprice desc", "p_partkey"]).drop("p_retailprice")


@section.query(
    "win_row_number_global",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders",
)
def win_row_number_global(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return O.number_rows(orders, ["o_totalprice desc", "o_orderkey"]).select("o_orderkey", "rn")


@section.query(
    "win_dense_rank_part",
    """SELECT l_orderkey, l_linenumber, p_brand, p_retailprice,
              DENSE_RANK() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS price_rank
       FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def win_dense_rank_part(t):
    sold = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_orderkey", "l_linenumber", "p_brand", "p_retailprice"
    )
    return O.rank_rows(sold, ["p_retailprice desc"], ["p_brand"], rank=None, dense="price_rank")


@section.query(
    "win_lag_lead_default",
    f"""SELECT r_name, order_month, CAST(revenue AS DOUBLE) AS revenue,
               CAST(LAG(revenue, 1, 0) OVER ({PER_REGION}) AS DOUBLE) AS before,
               CAST(LEAD(revenue, 1, 0) OVER ({PER_REGION}) AS DOUBLE) AS after,
               CAST(revenue - LAG(revenue, 1, 0) OVER ({PER_REGION}) AS DOUBLE) AS change FROM ({MONTHS})""",
)
def win_lag_lead_default(t):
    """With a default of 0 the first change of a region equals its revenue."""
    zero = F.lit(0).cast("decimal(24,2)")
    before = F.coalesce(F.lag("revenue").over(per_region()), zero)
    return region_months(t).select(
        "r_name",
        "order_month",
        as_double(F.col("revenue"), "revenue"),
        as_double(before, "before"),
        as_double(F.coalesce(F.lead("revenue").over(per_region()), zero), "after"),
        as_double(F.col("revenue") - before, "change"),
    )


@section.query(
    "win_lag_null",
    """SELECT o_custkey, o_orderkey, o_orderdate,
              LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_date FROM orders""",
)
def win_lag_null(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return O.running(orders, ["o_orderdate", "o_orderkey"], ["o_custkey"], previous={"previous_date": "o_orderdate"})


@section.query(
    "win_running_sum",
    f"""SELECT r_name, order_month, CAST(SUM(revenue) OVER ({PER_REGION}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM ({MONTHS})""",
)
def win_running_sum(t):
    so_far = per_region().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return region_months(t).select("r_name", "order_month", as_double(F.sum("revenue").over(so_far), "running_total"))


@section.query(
    "win_running_sum_global",
    f"""SELECT o_orderkey, o_orderdate, CAST(SUM({PRICE}) OVER (ORDER BY o_orderdate, o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""",
)
def win_running_sum_global(t):
    orders = t.orders.select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("price"))
    summed = O.running(orders, ["o_orderdate", "o_orderkey"], totals={"running_total": "price"})
    return summed.select("o_orderkey", "o_orderdate", as_double(F.col("running_total"), "running_total"))


def _frame_average(frame):
    return F.sum("revenue").over(frame).cast("double") / F.count("revenue").over(frame)


def _frame_sql(bounds, name):
    over = f"OVER ({PER_REGION} ROWS BETWEEN {bounds})"
    return f"CAST(SUM(revenue) {over} AS DOUBLE) / COUNT(revenue) {over} AS {name}"


@section.query(
    "win_moving_avg",
    f"SELECT r_name, order_month, {_frame_sql('2 PRECEDING AND CURRENT ROW', 'moving_average')} FROM ({MONTHS})",
)
def win_moving_avg(t):
    frame = per_region().rowsBetween(-2, Window.currentRow)
    return region_months(t).select("r_name", "order_month", _frame_average(frame).alias("moving_average"))


@section.query(
    "win_centered_frame",
    f"""SELECT r_name, order_month, {_frame_sql('1 PRECEDING AND 1 FOLLOWING', 'centered_average')},
        CAST(SUM(revenue) OVER ({PER_REGION} ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS DOUBLE) AS next_three
        FROM ({MONTHS})""",
)
def win_centered_frame(t):
    ahead = per_region().rowsBetween(Window.currentRow, 2)
    return region_months(t).select(
        "r_name",
        "order_month",
        _frame_average(per_region().rowsBetween(-1, 1)).alias("centered_average"),
        as_double(F.sum("revenue").over(ahead), "next_three"),
    )


WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


@section.query(
    "win_first_last",
    f"""SELECT r_name, order_month, CAST(FIRST_VALUE(revenue) OVER ({PER_REGION} {WHOLE}) AS DOUBLE) AS first_revenue,
               CAST(LAST_VALUE(revenue) OVER ({PER_REGION} {WHOLE}) AS DOUBLE) AS last_revenue FROM ({MONTHS})""",
)
def win_first_last(t):
    whole = per_region().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return region_months(t).select(
        "r_name",
        "order_month",
        as_double(F.first("revenue").over(whole), "first_revenue"),
        as_double(F.last("revenue").over(whole), "last_revenue"),
    )


@section.query(
    "win_last_value_default",
    f"""SELECT r_name, order_month, CAST(LAST_VALUE(revenue) OVER ({PER_REGION}) AS DOUBLE) AS last_revenue
        FROM ({MONTHS})""",
)
def win_last_value_default(t):
    """Without a frame the window ends at the current row, so this is the row's own value."""
    return region_months(t).select(
        "r_name", "order_month", as_double(F.last("revenue").over(per_region()), "last_revenue")
    )


LINE_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
PER_PART = "PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, price"
HOT_LINES = f"""(SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_partkey END AS l_partkey, l_shipdate,
                {LINE_PRICE} AS price FROM lineitem)"""


def hot_lines(t):
    """Order lines of which one part holds half."""
    part = F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", part.alias("l_partkey"), "l_shipdate", cents("l_extendedprice").alias("price"))


IN_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "price"]


@section.query(
    "win_lag_lead_lines",
    f"""SELECT l_orderkey, l_linenumber, CAST(LAG(price, 2, 0) OVER w AS DOUBLE) AS two_before, LEAD(l_shipdate) OVER w AS next_date,
               CAST(LEAD(price, 3, -1) OVER w AS DOUBLE) AS three_after FROM {HOT_LINES} WINDOW w AS ({PER_PART})""",
)
def win_lag_lead_lines(t):
    """LAG and LEAD with offset and default on detail rows, under a key that holds half of them."""
    looks = {
        "two_before": lambda w: F.lag("price", 2, Decimal(0)).over(w).cast("double"),
        "next_date": lambda w: F.lead("l_shipdate").over(w),
        "three_after": lambda w: F.lead("price", 3, Decimal(-1)).over(w).cast("double"),
    }
    return O.framed(hot_lines(t), IN_ORDER, looks, ["l_partkey"], before=2, after=3).select("l_orderkey", "l_linenumber", *looks)


def _lines_over(bounds, call, name):
    return f"CAST({call} OVER ({PER_PART} ROWS BETWEEN {bounds}) AS DOUBLE) AS {name}"


@section.query(
    "win_moving_lines",
    f"""SELECT l_orderkey, l_linenumber, {_lines_over('2 PRECEDING AND CURRENT ROW', 'SUM(price)', 'last_three')},
               {_lines_over('1 PRECEDING AND 1 FOLLOWING', 'MAX(price)', 'highest_near')},
               {_lines_over('CURRENT ROW AND 2 FOLLOWING', 'SUM(price)', 'next_three')},
               {_lines_over('2 PRECEDING AND 2 FOLLOWING', 'FIRST_VALUE(price)', 'frame_first')},
               {_lines_over('2 PRECEDING AND 2 FOLLOWING', 'LAST_VALUE(price)', 'frame_last')} FROM {HOT_LINES}""",
)
def win_moving_lines(t):
    """Moving frames on detail rows."""
    looks = {
        "last_three": lambda w: F.sum("price").over(w.rowsBetween(-2, 0)).cast("double"),
        "highest_near": lambda w: F.max("price").over(w.rowsBetween(-1, 1)).cast("double"),
        "next_three": lambda w: F.sum("price").over(w.rowsBetween(0, 2)).cast("double"),
        "frame_first": lambda w: F.first("price").over(w.rowsBetween(-2, 2)).cast("double"),
        "frame_last": lambda w: F.last("price").over(w.rowsBetween(-2, 2)).cast("double"),
    }
    return O.framed(hot_lines(t), IN_ORDER, looks, ["l_partkey"], before=2, after=2).select("l_orderkey", "l_linenumber", *looks)


@section.query(
    "win_first_last_lines",
    f"""SELECT l_orderkey, l_linenumber, CAST(FIRST_VALUE(price) OVER ({PER_PART}) AS DOUBLE) AS first_price,
               CAST(LAST_VALUE(price) OVER ({PER_PART} {WHOLE}) AS DOUBLE) AS last_price FROM {HOT_LINES}""",
)
def win_first_last_lines(t):
    """First and last value of a group beside its detail rows; the last is the first in reverse."""
    backward = [f"{c} desc" for c in IN_ORDER]
    last = O.running(hot_lines(t), backward, ["l_partkey"], firsts={"last_price": "price"})
    both = O.running(last, IN_ORDER, ["l_partkey"], firsts={"first_price": "price"})
    return both.select("l_orderkey", "l_linenumber", as_double(F.col("first_price"), "first_price"), as_double(F.col("last_price"), "last_price"))


@section.query(
    "win_range_vs_rows",
    f"""WITH y AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus, SUM({PRICE}) AS revenue
                   FROM orders GROUP BY ALL)
        SELECT o_orderpriority, y, o_orderstatus,
               CAST(SUM(revenue) OVER (PARTITION BY o_orderpriority ORDER BY y
                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS range_total,
               CAST(SUM(revenue) OVER (PARTITION BY o_orderpriority ORDER BY y, o_orderstatus
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS rows_total FROM y""",
)
def win_range_vs_rows(t):
    """Years tie across the three statuses: RANGE gives all of them the same total."""
    yearly = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y"), "o_orderstatus").agg(
        sum_amount("o_totalprice").alias("revenue")
    )
    one = Window.partitionBy("o_orderpriority")
    by_range = one.orderBy("y").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    by_rows = one.orderBy("y", "o_orderstatus").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return yearly.select(
        "o_orderpriority",
        "y",
        "o_orderstatus",
        as_double(F.sum("revenue").over(by_range), "range_total"),
        as_double(F.sum("revenue").over(by_rows), "rows_total"),
    )


@section.query(
    "win_partition_aggs",
    f"""SELECT o_orderkey, o_orderpriority, CAST(SUM({PRICE}) OVER w AS DOUBLE) AS group_total,
               CAST(SUM({PRICE}) OVER w AS DOUBLE) / COUNT(*) OVER w AS group_average, COUNT(*) OVER w AS group_rows
        FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""",
)
def win_partition_aggs(t):
    return W.with_group_aggregates(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
        ["o_orderpriority"],
        [
            total("o_totalprice").alias("group_total"),
            mean("o_totalprice").alias("group_average"),
            F.count(F.lit(1)).alias("group_rows"),
        ],
    ).drop("o_totalprice")


@section.query(
    "win_pct_of_partition",
    f"""SELECT r_name, order_month, CAST(100.0 * revenue / SUM(revenue) OVER (PARTITION BY r_name) AS DECIMAL(5,2)) AS pct
        FROM ({MONTHS})""",
)
def win_pct_of_partition(t):
    whole = F.sum("revenue").over(Window.partitionBy("r_name")).cast("decimal(24,2)")
    return region_months(t).select(
        "r_name", "order_month", percent(F.col("revenue"), whole, "decimal(5,2)").alias("pct")
    )


@section.query(
    "win_pct_of_total",
    f"SELECT o_orderkey, CAST(100.0 * {PRICE} / SUM({PRICE}) OVER () AS DECIMAL(9,6)) AS pct FROM orders",
)
def win_pct_of_total(t):
    price = cents("o_totalprice")
    whole = t.orders.agg(sum_amount("o_totalprice")).scalar()
    return t.orders.select("o_orderkey", percent(price, whole, "decimal(9,6)").alias("pct"))


@section.query(
    "win_period_growth",
    f"""SELECT r_name, order_month, CAST(revenue AS DOUBLE) AS revenue,
               CAST(100.0 * (revenue - prev) / NULLIF(prev, 0) AS DECIMAL(10,1)) AS growth_pct
        FROM (SELECT *, LAG(revenue) OVER ({PER_REGION}) AS prev FROM ({MONTHS}))""",
)
def win_period_growth(t):
    grown = add_growth(region_months(t), ["r_name"], "order_month", "revenue")
    return grown.withColumn("revenue", F.col("revenue").cast("double"))


@section.query(
    "win_over_aggregate",
    """SELECT c_nationkey, o_orderpriority, COUNT(*) AS n_orders, MIN(o_orderdate) AS first_date,
              CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY COUNT(*) DESC, MIN(o_orderdate), o_orderpriority)
                   AS INTEGER) AS rn
       FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def win_over_aggregate(t):
    counted = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_orderdate").alias("first_date"))
    )
    place = Window.partitionBy("c_nationkey").orderBy(F.col("n_orders").desc(), "first_date", "o_orderpriority")
    return counted.withColumn("rn", F.row_number().over(place))


NATION_ORDERS = """SELECT n_name, o_orderkey, o_totalprice, CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey
    ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey"""


def _biggest_orders(t, n):
    orders = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("n_name", "c_nationkey", "o_orderkey", "o_totalprice")
    )
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return first_per_key(orders, ["c_nationkey"], order, n, rank="rn").drop("c_nationkey")


@section.query("win_topn_per_group", f"SELECT * FROM ({NATION_ORDERS}) WHERE rn <= 3")
def win_topn_per_group(t):
    return _biggest_orders(t, 3)


@section.query("win_rank_range", f"SELECT * FROM ({NATION_ORDERS}) WHERE rn BETWEEN 4 AND 6")
def win_rank_range(t):
    return _biggest_orders(t, 6).where("rn >= 4")


@section.query(
    "win_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def win_latest_per_key(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


FEED = """SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS day, ROW_NUMBER() OVER (
    PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events"""


@section.query("dedup_preview", f"SELECT * FROM ({FEED}) WHERE rn > 1")
def dedup_preview(t):
    feed = t.events.select("event_id", "ts", "user_id", "event_type", F.to_date("ts").alias("day"))
    return W.mark_copies(feed, ["user_id", "day", "event_type"], ["ts", "event_id"]).where("rn > 1")


ISLANDS = """WITH v AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
    n AS (SELECT *, day - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM v),
    i AS (SELECT user_id, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_days FROM n GROUP BY user_id, run)"""


def purchase_days(t):
    return t.events.where("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("day"))


@section.query("gaps_islands", ISLANDS + " SELECT * FROM i")
def gaps_islands(t):
    return W.islands(purchase_days(t), "user_id", "day")


@section.query(
    "longest_streak",
    ISLANDS
    + """ SELECT user_id, first_day, last_day, n_days FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n_days DESC, first_day) AS rn FROM i) WHERE rn = 1""",
)
def longest_streak(t):
    return W.longest_island(purchase_days(t), "user_id", "day")


@section.query(
    "running_total_and_share",
    f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, SUM({PRICE}) AS revenue
                   FROM orders GROUP BY 1)
        SELECT order_month, CAST(revenue AS DOUBLE) AS revenue, CAST(SUM(revenue) OVER (ORDER BY order_month
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total,
               CAST(100.0 * revenue / SUM(revenue) OVER () AS DECIMAL(5,2)) AS pct FROM m""",
)
def running_total_and_share(t):
    """Months only reach the one-partition window: their number is bounded by the calendar."""
    monthly = t.orders.groupBy(month_of("o_orderdate").alias("order_month")).agg(
        sum_amount("o_totalprice").alias("revenue")
    )
    line = Window.orderBy("order_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("revenue").over(Window.partitionBy()).cast("decimal(24,2)")
    return monthly.select(
        "order_month",
        as_double(F.col("revenue"), "revenue"),
        as_double(F.sum("revenue").over(line), "running_total"),
        percent(F.col("revenue"), whole, "decimal(5,2)").alias("pct"),
    )


def _study_sql(group, month, source, top):
    line = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
    return f"""WITH l AS (SELECT {group}, CAST(date_trunc('month', {month}) AS DATE) AS month, p_name, {line} AS amount
                          FROM {source} JOIN part ON p_partkey = l_partkey),
      m AS (SELECT {group}, month, SUM(amount) AS revenue FROM l GROUP BY 1, 2),
      g AS (SELECT *, LAG(revenue) OVER (PARTITION BY {group} ORDER BY month) AS prev FROM m),
      p AS (SELECT {group}, month, p_name, SUM(amount) AS product_revenue FROM l GROUP BY 1, 2, 3),
      r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {group}, month ORDER BY product_revenue DESC, p_name) AS rn FROM p)
      SELECT g.{group}, g.month, CAST(revenue AS DOUBLE) AS revenue,
             CAST(100.0 * (revenue - prev) / NULLIF(prev, 0) AS DECIMAL(10,1)) AS growth_pct, p_name,
             CAST(product_revenue AS DOUBLE) AS product_revenue,
             CAST(100.0 * product_revenue / revenue AS DECIMAL(5,1)) AS contribution_pct
      FROM g JOIN r ON r.{group} = g.{group} AND r.month = g.month WHERE rn <= {top}"""


@section.query(
    "case_study_sales",
    _study_sql(
        "n_name",
        "o_orderdate",
        """lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey""",
        3,
    ),
)
def case_study_sales(t):
    """Revenue, growth and the three leading products of each nation and month."""
    lines = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .select("c_nationkey", month_of("o_orderdate").alias("month"), "p_name", line_units().alias("amount"))
    )
    report = growth_report(lines, "c_nationkey", "month", "p_name", "amount", top=3)
    return report.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("n_name", *report.columns[1:])


@section.query(
    "case_study_vendor",
    _study_sql("s_name", "l_shipdate", "lineitem JOIN supplier ON s_suppkey = l_suppkey", 2),
)
def case_study_vendor(t):
    """The same report for suppliers by month of shipment, with two products."""
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_suppkey", month_of("l_shipdate").alias("month"), "p_name", line_units().alias("amount")
    )
    report = growth_report(lines, "l_suppkey", "month", "p_name", "amount", top=2)
    return report.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select("s_name", *report.columns[1:])
