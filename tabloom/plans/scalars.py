"""Scalar functions over table columns."""

import random

from pyspark.sql import functions as F

from tabloom.functions import scalars as S, xml
from tabloom.plans.registry import Section, cents

section = Section()
ACCT = "CAST(c_acctbal AS DECIMAL(18,2))"
COLOR = "NULLIF(p_type, 'ECONOMY')"


def color():
    return F.nullif(F.col("p_type"), F.lit("ECONOMY"))


@section.query(
    "fn_len",
    r"""SELECT doc_id, CAST(length(rtrim(text, ' ')) AS INTEGER) AS n_characters,
               CAST(2 * length(text) + 2 * length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS INTEGER) AS n_bytes
        FROM documents""",
)
def fn_len(t):
    return t.documents.select(
        "doc_id", S.text_length("text").alias("n_characters"), S.utf16_bytes("text").alias("n_bytes")
    )


@section.query(
    "fn_substr",
    """SELECT c_custkey, left(c_name, 8) AS head, right(c_name, 4) AS tail, substring(c_name, 2, 3) AS middle FROM customer""",
)
def fn_substr(t):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.left(name, F.lit(8)).alias("head"),
        F.right(name, F.lit(4)).alias("tail"),
        F.substring(name, 2, 3).alias("middle"),
    )


@section.query("fn_charindex", "SELECT p_partkey, CAST(strpos(p_name, 'l') AS INTEGER) AS at FROM part")
def fn_charindex(t):
    return t.part.select("p_partkey", S.find_text("l", "p_name").alias("at"))


@section.query(
    "fn_string_basic",
    """SELECT p_partkey, replace(p_name, 'ring', 'RING') AS replaced, upper(p_name) AS big, lower(p_brand) AS small,
              ltrim('  ' || p_name || '  ', ' ') AS l, rtrim('  ' || p_name || '  ', ' ') AS r,
              trim('  ' || p_name || '  ', ' ') AS lr FROM part""",
)
def fn_string_basic(t):
    padded = F.concat(F.lit("  "), "p_name", F.lit("  "))
    return t.part.select(
        "p_partkey",
        F.replace("p_name", F.lit("ring"), F.lit("RING")).alias("replaced"),
        F.upper("p_name").alias("big"),
        F.lower("p_brand").alias("small"),
        F.ltrim(padded).alias("l"),
        F.rtrim(padded).alias("r"),
        F.trim(padded).alias("lr"),
    )


@section.query(
    "fn_concat_null",
    f"""SELECT p_partkey, p_name || '-' || {COLOR} AS plus_form, concat(p_name, '-', {COLOR}) AS concat_form FROM part""",
)
def fn_concat_null(t):
    return t.part.select(
        "p_partkey",
        S.plus_text("p_name", F.lit("-"), color()).alias("plus_form"),
        S.concat_text("p_name", F.lit("-"), color()).alias("concat_form"),
    )


@section.query(
    "fn_pad_repeat",
    """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS code, repeat('x', CAST(c_nationkey AS INTEGER)) AS bar,
              right('000' || CAST(c_custkey AS VARCHAR), 3) AS short_code FROM customer""",
)
def fn_pad_repeat(t):
    return t.customer.select(
        "c_custkey",
        S.zero_pad("c_custkey", 10).alias("code"),
        F.repeat(F.lit("x"), F.col("c_nationkey")).alias("bar"),
        S.zero_pad("c_custkey", 3).alias("short_code"),
    )


@section.query("fn_format_number", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS shown FROM orders")
def fn_format_number(t):
    return t.orders.select("o_orderkey", S.format_amount(cents("o_totalprice")).alias("shown"))


@section.query(
    "fn_format_money",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '($' || format('{:,.2f}', -c_acctbal) || ')'
              ELSE '$' || format('{:,.2f}', c_acctbal) END AS shown FROM customer""",
)
def fn_format_money(t):
    return t.customer.select("c_custkey", S.format_money(cents("c_acctbal")).alias("shown"))


@section.query(
    "fn_quote_generate",
    """SELECT DISTINCT 'ANALYZE TABLE `' || replace(p_brand || '`' || p_type, '`', '``') || '` COMPUTE STATISTICS;' AS statement
       FROM part""",
)
def fn_quote_generate(t):
    names = t.part.select(F.concat("p_brand", F.lit("`"), "p_type").alias("name")).distinct()
    return names.select(
        F.concat(F.lit("ANALYZE TABLE "), S.quote_name("name"), F.lit(" COMPUTE STATISTICS;")).alias("statement")
    )


@section.query("fn_now")
def fn_now(t):
    now = F.current_timestamp()
    past = F.count_if(F.col("o_orderdate") < F.localtimestamp())
    return t.orders.agg(past.alias("n_past")).select(
        "n_past",
        F.localtimestamp().alias("local_now"),
        F.to_utc_timestamp(now, F.current_timezone()).cast("timestamp_ntz").alias("utc_now"),
    )


@section.query("fn_now_holds", "SELECT COUNT(*) AS n_past, 1 AS n_times, TRUE AS utc_follows FROM orders")
def fn_now_holds(t):
    """One time for the whole query, after all orders; UTC is the local time less the zone's offset."""
    held = t.orders.select("o_orderdate", F.localtimestamp().alias("local"), F.current_timestamp().alias("now"))
    shifted = F.to_utc_timestamp(F.col("local").cast("timestamp"), F.current_timezone())
    utc = F.to_utc_timestamp("now", F.current_timezone())
    return held.agg(
        F.count_if(F.col("o_orderdate") < F.col("local")).alias("n_past"),
        F.count_distinct("local").cast("int").alias("n_times"),
        F.every(F.abs(F.unix_micros(utc) - F.unix_micros(shifted)) < 1).alias("utc_follows"),
    )


@section.query(
    "fn_dateadd",
    """SELECT o_orderkey, o_orderdate + INTERVAL 10 DAY AS d, o_orderdate + INTERVAL 1 MONTH AS m,
              o_orderdate - INTERVAL 1 YEAR AS y, o_orderdate + INTERVAL 36 HOUR AS h FROM orders""",
)
def fn_dateadd(t):
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        S.date_plus("day", 10, at).alias("d"),
        S.date_plus("month", 1, at).alias("m"),
        S.date_plus("year", -1, at).alias("y"),
        S.date_plus("hour", 36, at).alias("h"),
    )


def _add_datediff(part):
    @section.query(
        f"fn_datediff_{part}",
        f"""SELECT l_orderkey, l_linenumber, CAST(date_diff('{part}', o_orderdate, l_shipdate) AS INTEGER) AS n
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    )
    def datediff(t):
        joined = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        return joined.select(
            "l_orderkey", "l_linenumber", S.boundaries_between(part, "o_orderdate", "l_shipdate").alias("n")
        )


for _part in ("year", "month", "day"):
    _add_datediff(_part)


@section.query(
    "fn_datediff_clock",
    """SELECT event_id, CAST(date_diff('day', DATE '1899-12-31', CAST(ts AS DATE)) // 7 - date_diff('day', DATE '1899-12-31', CAST(since AS DATE)) // 7 AS INTEGER) AS weeks,
              date_diff('minute', since, ts) AS minutes, date_diff('second', since, ts) AS seconds,
              date_diff('millisecond', since, ts) AS milliseconds, CAST(millisecond(ts) % 1000 AS INTEGER) AS millisecond
       FROM events JOIN (SELECT user_id, min(ts) AS since FROM events GROUP BY user_id) AS f USING (user_id)""",
)
def fn_datediff_clock(t):
    """Boundaries between the first event of a user and each of the user's events."""
    events = t.events.join(t.events.groupBy("user_id").agg(F.min("ts").alias("since")), "user_id")
    counted = (S.boundaries_between(part, "since", "ts").alias(f"{part}s") for part in ("week", "minute", "second", "millisecond"))
    return events.select("event_id", *counted, S.millisecond("ts").alias("millisecond"))


@section.query(
    "fn_dateparts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d,
              CAST(hour(ts) AS INTEGER) AS h, CAST(quarter(ts) AS INTEGER) AS q, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
              CAST(dayofyear(ts) AS INTEGER) AS yearday, monthname(ts) AS month_name, dayname(ts) AS day_name FROM events""",
)
def fn_dateparts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"),
        F.hour(ts).alias("h"),
        F.quarter(ts).alias("q"),
        F.dayofweek(ts).alias("weekday"),
        F.dayofyear(ts).alias("yearday"),
        F.date_format(ts, "MMMM").alias("month_name"),
        F.date_format(ts, "EEEE").alias("day_name"),
    )


@section.query(
    "fn_month_bounds",
    """SELECT o_orderkey, last_day(o_orderdate) AS month_end,
              make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start FROM orders""",
)
def fn_month_bounds(t):
    return t.orders.select(
        "o_orderkey", S.month_end("o_orderdate").alias("month_end"), S.month_start("o_orderdate").alias("month_start")
    )


@section.query(
    "fn_date_style",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d') AS iso_day,
              strftime(ts, '%d/%m/%Y') AS british, strftime(ts, '%m/%d/%Y') AS american, strftime(ts, '%Y-%m') AS iso_month
       FROM events""",
)
def fn_date_style(t):
    return t.events.select(
        "event_id",
        S.date_text("ts", 120).alias("iso"),
        S.date_text("ts", 120, 10).alias("iso_day"),
        S.date_text("ts", 103, 10).alias("british"),
        S.date_text("ts", 101, 10).alias("american"),
        S.date_text("ts", 120, 7).alias("iso_month"),
    )


@section.query("fn_cast_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def fn_cast_date(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@section.query(
    "fn_age_years",
    "SELECT o_orderkey, CAST(date_sub('year', o_orderdate, TIMESTAMP '2001-05-17') AS INTEGER) AS age FROM orders WHERE o_orderdate <= TIMESTAMP '2001-05-17'",
)
def fn_age_years(t):
    as_of = F.lit("2001-05-17").cast("timestamp_ntz")
    past = t.orders.where(F.col("o_orderdate") <= as_of)
    return past.select("o_orderkey", S.age_years("o_orderdate", as_of).alias("age"))


@section.query(
    "fn_math",
    f"""SELECT c_custkey, CAST(round({ACCT}, 1) AS DOUBLE) AS rounded, CAST(floor({ACCT}) AS BIGINT) AS low,
               CAST(ceil({ACCT}) AS BIGINT) AS high, CAST(abs({ACCT}) AS DOUBLE) AS size,
               power(c_nationkey, 2) AS squared, sqrt(abs(c_acctbal)) AS root FROM customer""",
)
def fn_math(t):
    balance = cents("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.round(balance, 1).cast("double").alias("rounded"),
        F.floor(balance).cast("bigint").alias("low"),
        F.ceil(balance).cast("bigint").alias("high"),
        F.abs(balance).cast("double").alias("size"),
        F.power("c_nationkey", F.lit(2)).alias("squared"),
        F.sqrt(F.abs("c_acctbal")).alias("root"),
    )


@section.query("fn_random")
def fn_random(t):
    """One random number for the whole query beside one per row."""
    return t.orders.select(
        "o_orderkey",
        F.lit(random.random()).alias("per_query"),
        F.rand(seed=7).alias("per_row"),
        F.uuid().alias("row_guid"),
    )


@section.query(
    "fn_random_holds",
    "SELECT 1 AS n_per_query, TRUE AS in_range, TRUE AS rows_differ, COUNT(*) AS n_guids FROM orders",
)
def fn_random_holds(t):
    """One number for the query, one in [0, 1) for each row, and no identifier twice."""
    return fn_random(t).agg(
        F.count_distinct("per_query").cast("int").alias("n_per_query"),
        F.every(F.col("per_row").between(0, 1) & (F.col("per_row") < 1)).alias("in_range"),
        (F.count_distinct("per_row") > F.count(F.lit(1)) * 0.99).alias("rows_differ"),
        F.count_distinct("row_guid").alias("n_guids"),
    )


@section.query("fn_int_div", "SELECT o_orderkey, o_custkey // 7 AS sevenths, (-o_custkey) // 7 AS negative FROM orders")
def fn_int_div(t):
    return t.orders.select(
        "o_orderkey",
        S.int_div("o_custkey", F.lit(7)).alias("sevenths"),
        S.int_div(-F.col("o_custkey"), F.lit(7)).alias("negative"),
    )


@section.query(
    "fn_cast",
    """SELECT p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS whole, CAST(p_partkey AS VARCHAR) AS text_key,
              CAST(p_size AS DOUBLE) AS size, CAST(CAST(p_partkey AS VARCHAR) AS BIGINT) AS back FROM part""",
)
def fn_cast(t):
    return t.part.select(
        "p_partkey",
        F.col("p_retailprice").cast("decimal(18,2)").cast("int").alias("whole"),
        F.col("p_partkey").cast("string").alias("text_key"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_partkey").cast("string").cast("bigint").alias("back"),
    )


@section.query(
    "fn_try_cast_flag",
    """SELECT o_orderkey, TRY_CAST(dirty AS INTEGER) AS number, CASE WHEN TRY_CAST(dirty AS INTEGER) IS NOT NULL
              THEN 1 ELSE 0 END AS is_number
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN left(o_orderpriority, 1) ELSE o_orderpriority END AS dirty
             FROM orders)""",
)
def fn_try_cast_flag(t):
    priority = F.col("o_orderpriority")
    dirty = F.when(F.col("o_orderstatus") == "F", F.left(priority, F.lit(1))).otherwise(priority)
    orders = t.orders.select("o_orderkey", dirty.alias("dirty"))
    return orders.select(
        "o_orderkey", F.col("dirty").try_cast("int").alias("number"), S.is_number("dirty").alias("is_number")
    )


@section.query(
    "fn_null_handling",
    f"""SELECT p_partkey, COALESCE({COLOR}, 'none') AS color, COALESCE(NULLIF(p_size, 7), 0) AS size,
               COALESCE({COLOR}, NULLIF(p_brand, 'Brand#1'), p_name) AS first_known FROM part""",
)
def fn_null_handling(t):
    return t.part.select(
        "p_partkey",
        S.is_null(color(), "none", "string").alias("color"),
        S.is_null(F.nullif("p_size", F.lit(7)), 0, "int").alias("size"),
        F.coalesce(color(), F.nullif("p_brand", F.lit("Brand#1")), F.col("p_name")).alias("first_known"),
    )


@section.query(
    "fn_money_vs_decimal",
    """SELECT p_partkey, CAST(p_retailprice / 3 AS DECIMAL(12,6)) AS exact_third,
              CAST((CAST(round(p_retailprice * 10000) AS BIGINT) // 3) / 10000 AS DECIMAL(19,4)) AS money_third,
              CAST((CAST(round(p_retailprice * 10000) AS BIGINT) // 3 * 3) / 10000 AS DECIMAL(19,4)) AS money_back FROM part""",
)
def fn_money_vs_decimal(t):
    price = cents("p_retailprice")
    third = S.money_div(price, F.lit(3))
    return t.part.select(
        "p_partkey",
        (price.cast("decimal(10,4)") / F.lit(3)).cast("decimal(12,6)").alias("exact_third"),
        third.alias("money_third"),
        S.money(third * 3).alias("money_back"),
    )


@section.query(
    "fn_non_ascii_report",
    r"""SELECT doc_id, lang, CAST(length(text) - length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS INTEGER) AS n_lost,
               md5(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS kept_md5
        FROM documents WHERE regexp_matches(text, '[^\x00-\x7F]')""",
)
def fn_non_ascii_report(t):
    return (
        t.documents.select(
            "doc_id",
            "lang",
            S.lost_characters("text").alias("n_lost"),
            F.md5(S.lossy_ascii("text")).alias("kept_md5"),
        )
        .where("n_lost > 0")
    )


@section.query(
    "xml_shred",
    """SELECT event_id, t, v, '<e t="' || t || '" v="' || CAST(v AS VARCHAR) || '"/>' AS node_xml FROM (
         SELECT event_id, event_type AS t, value AS v FROM events
         UNION ALL SELECT event_id, 'user', CAST(user_id AS DOUBLE) FROM events)""",
)
def xml_shred(t):
    value_node = xml.element("e", {"t": F.col("event_type"), "v": F.col("value")})
    user_node = xml.element("e", {"t": F.lit("user"), "v": F.col("user_id")})
    documents = t.events.select(
        "event_id", F.concat(F.lit("<r>"), value_node, user_node, F.lit("</r>")).alias("body")
    )
    return xml.shred(documents, "body", "e", {"t": "string", "v": "double"}, subtree="node_xml")
