"""Column expressions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.analogs import RESULTS
from checks.registry import check, load, run
from matchloom import functions as fn

DATE = "CAST(o_orderdate AS date)"


@check(
    "F1_season_end_year",
    f"""SELECT o_orderkey,
    CAST(CASE WHEN month({DATE}) <= 7 THEN year({DATE}) ELSE year({DATE}) + 1 END AS bigint) AS extract_season,
    CAST(CASE WHEN month({DATE}) <= 6 THEN year({DATE}) ELSE year({DATE}) + 1 END AS bigint) AS ingest_season
    FROM orders""",
)
def season_end_year(spark, d):
    date = F.col("o_orderdate").cast("date")
    return load(spark, d, "orders").select(
        "o_orderkey",
        fn.season_end_year(date).cast("bigint").alias("extract_season"),
        fn.season_end_year(date, 6).cast("bigint").alias("ingest_season"),
    )


@check(
    "F2_season_start_year",
    f"""SELECT o_orderkey, CAST(CASE WHEN month({DATE}) > 6 THEN year({DATE}) ELSE year({DATE}) - 1 END AS bigint)
    AS season FROM orders""",
)
def season_start_year(spark, d):
    season = fn.season_start_year(F.col("o_orderdate").cast("date")).cast("bigint")
    return load(spark, d, "orders").select("o_orderkey", season.alias("season"))


@check(
    "F3_current_season",
    f"""SELECT o_orderkey, CAST(year({DATE}) + CASE WHEN month({DATE}) < 7 THEN 0 ELSE 1 END AS bigint) AS season,
    {DATE} > DATE '1999-06-30' AS in_season FROM orders""",
)
def current_season(spark, d):
    # a season that ends in June is current until its last month is over
    season = fn.season_end_year(F.col("o_orderdate").cast("date"), 6).cast("bigint")
    this = fn.current_season(dt.date(1999, 7, 1))
    return load(spark, d, "orders").select(
        "o_orderkey", season.alias("season"), (season >= this).alias("in_season")
    )


@check(
    "F4_parse_date",
    f"""SELECT o_orderkey, CAST({DATE} AS string) AS from_text, CAST({DATE} AS string) AS from_days,
    CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {DATE} END AS string) AS from_dirty,
    CAST({DATE} AS string) AS from_cell FROM orders""",
)
def parse_date(spark, d):
    orders = load(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    text = F.col("day").cast("string")
    days = F.unix_date("day")
    dirty = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(text)
    cell = F.when(F.col("o_orderstatus") == "F", days.cast("double").cast("string")).otherwise(text)
    return orders.select(
        "o_orderkey",
        fn.parse_date(text).cast("string").alias("from_text"),
        fn.parse_date(days.cast("double"), T.DoubleType()).cast("string").alias("from_days"),
        fn.parse_date(dirty).cast("string").alias("from_dirty"),
        fn.parse_date(cell).cast("string").alias("from_cell"),
    )


@check(
    "F5_url_segment",
    """SELECT MatchKey, split_part(MatchURL, '/', 7) AS last_part, split_part(MatchURL, '/', 6) AS match_id,
    CAST(NULL AS string) AS absent FROM results""",
    results=RESULTS,
)
def url_segment(spark, d):
    url = F.col("MatchURL")
    return run(spark, d, RESULTS).select(
        "MatchKey",
        fn.url_segment(url, -1).alias("last_part"),
        fn.url_segment(url, -2).alias("match_id"),
        fn.url_segment(url, -20).alias("absent"),
    )


@check(
    "F6_page_path",
    "SELECT MatchKey, 'stage/html/' || Country || '/' || split_part(MatchURL, '/', 7) || '.html' AS path FROM results",
    results=RESULTS,
)
def page_path(spark, d):
    path = fn.page_path(F.col("Country"), F.col("MatchURL"))
    return run(spark, d, RESULTS).select("MatchKey", path.alias("path"))


@check(
    "F7_map_value",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'GER' WHEN 'FURNITURE' THEN 'ESP'
    ELSE c_mktsegment END AS kept, CASE c_mktsegment WHEN 'BUILDING' THEN 'GER' WHEN 'FURNITURE' THEN 'ESP' END
    AS nulled, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'FURNITURE' THEN 'F' WHEN 'MACHINERY' THEN 'M'
    WHEN 'HOUSEHOLD' THEN 'H' WHEN 'AUTOMOBILE' THEN 'A' END AS strict FROM customer""",
)
def map_value(spark, d):
    some = {"BUILDING": "GER", "FURNITURE": "ESP"}
    every = {s: s[0] for s in ("BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE")}
    segment = F.col("c_mktsegment")
    return load(spark, d, "customer").select(
        "c_custkey",
        fn.map_value(segment, some).alias("kept"),
        fn.map_value(segment, some, "null").alias("nulled"),
        fn.map_value(segment, every, "error").alias("strict"),
    )


@check(
    "F8_formation",
    """SELECT p_partkey, (p_size // 10) || '-' || (p_size % 10) || '-1' || CASE WHEN p_type = 'PROMO'
    THEN '-diamond' ELSE '' END AS plain, (p_size // 10) || '-' || (p_size % 10) || CASE WHEN p_type = 'PROMO'
    THEN '-diamond' ELSE '' END AS escaped FROM part""",
)
def formation(spark, d):
    part = load(spark, d, "part")
    mark = F.col("p_type") == "PROMO"
    tens, ones = (F.floor(F.col("p_size") / 10), F.col("p_size") % 10)
    plain = F.concat(
        F.lit("Team ("), tens, F.lit("-"), ones, F.lit("-1"), F.when(mark, "◆").otherwise(""), F.lit(")")
    )
    escaped = F.concat(F.lit("Team ("), tens, F.lit("-"), ones, F.when(mark, "<U+25C6>)").otherwise(")"))
    return part.select("p_partkey", fn.formation(plain).alias("plain"), fn.formation(escaped).alias("escaped"))


# an event line of known parts; shootouts, added time, own goals and penalties by event type
EVENT_LINES = """SELECT event_id, user_id, event_type, event_id % 5 AS g, user_id % 7 AS h, user_id % 45 + 1 AS kick,
    CASE event_type WHEN 'view' THEN '45+' || CAST(user_id % 6 + 1 AS string)
        WHEN 'signup' THEN 'Pen ' || CAST(user_id % 45 + 1 AS string)
        ELSE CAST(event_id % 125 + 1 AS string) END AS clock
    FROM {events}"""
EVENT_TEXT = """concat(clock, '&rsquor; ', CASE WHEN event_type = 'signup' THEN concat(CAST(kick AS string), ' ')
    ELSE '' END, CASE WHEN event_type = 'error' THEN '' ELSE concat(CAST(g AS string), ':', CAST(h AS string), ' ') END,
    '  Player', CAST(user_id AS string), 'x Assist:   Mate — ', CASE event_type WHEN 'click' THEN 'Penalty Kick'
    WHEN 'purchase' THEN 'Own Goal' ELSE event_type END, ' ', CAST(g AS string), ':', CAST(h AS string))"""


def event_lines(spark, d):
    lines = run(spark, d, EVENT_LINES)
    return lines.withColumn("line", fn.squish(F.expr(EVENT_TEXT)))


@check(
    "F9_event_minute",
    """SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 45 + user_id % 6 + 1 WHEN 'signup' THEN 121
    ELSE event_id % 125 + 1 END AS double) AS minute,
    CAST(CASE WHEN event_type = 'view' THEN 1 WHEN event_type = 'signup' THEN 5 WHEN event_id % 125 + 1 <= 45 THEN 1
    WHEN event_id % 125 + 1 <= 90 THEN 2 WHEN event_id % 125 + 1 <= 105 THEN 3 WHEN event_id % 125 + 1 <= 120 THEN 4
    ELSE 5 END AS bigint) AS half, event_type = 'signup' AS shootout FROM events""",
)
def event_minute(spark, d):
    line = F.col("line")
    return event_lines(spark, d).select(
        "event_id",
        fn.event_minute(line).alias("minute"),
        fn.event_half(line).cast("bigint").alias("half"),
        fn.is_shootout(line).alias("shootout"),
    )


@check(
    "F10_event_type",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Penalty' WHEN 'purchase' THEN 'Own Goal'
    WHEN 'signup' THEN 'Penalty Shootout' ELSE event_type END AS type FROM events""",
)
def event_type(spark, d):
    return event_lines(spark, d).select("event_id", fn.event_type(F.col("line")).alias("type"))


@check(
    "F11_event_players",
    """SELECT event_id, 'Player' || user_id || 'x Assist: Mate' AS players,
    CASE WHEN event_type = 'error' THEN NULL ELSE (event_id % 5) || ':' || (user_id % 7) END AS score,
    CAST(CASE WHEN event_type = 'signup' THEN user_id % 45 + 1 END AS double) AS penalty FROM events""",
)
def event_players(spark, d):
    line = F.col("line")
    return event_lines(spark, d).select(
        "event_id",
        fn.event_players(line).alias("players"),
        fn.score_progression(line).alias("score"),
        fn.penalty_number(line).alias("penalty"),
    )


@check(
    "F12_squish",
    """SELECT doc_id, trim(regexp_replace(text, '[\\s\\x0B\\pZ]+', ' ', 'g')) AS squished FROM documents""",
)
def squish(spark, d):
    return load(spark, d, "documents").select("doc_id", fn.squish(F.col("text")).alias("squished"))


@check(
    "F13_float_to_int",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_extendedprice) AS bigint) AS whole,
    CAST(CASE WHEN l_returnflag = 'A' THEN NULL ELSE trunc(l_extendedprice) END AS bigint) AS dirty FROM lineitem""",
)
def float_to_int(spark, d):
    price = F.col("l_extendedprice").cast("string")
    dirty = F.when(F.col("l_returnflag") != "A", price).when(F.col("l_linestatus") == "O", "NaN").otherwise("x")
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.float_to_int(price).alias("whole"),
        fn.float_to_int(dirty).alias("dirty"),
    )


@check(
    "F14_expected_families",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN FALSE ELSE year(o_orderdate) >= 1998 END AS advanced,
    CASE WHEN (year(o_orderdate) + 20 > 2017 AND o_orderpriority = '1-URGENT') OR (year(o_orderdate) + 20 > 2018
    AND o_orderpriority = '2-HIGH') THEN 'summary,keeper,passing,passing_types,possession,defense,misc'
    ELSE 'summary' END AS families FROM orders""",
)
def expected_families(spark, d):
    tiers = {"1-URGENT": "1st", "2-HIGH": "2nd"}
    season = F.year("o_orderdate")
    minimum = F.when(F.col("o_orderstatus") != "P", 1998)
    families = fn.expected_families(season + 20, fn.map_value(F.col("o_orderpriority"), tiers))
    return load(spark, d, "orders").select(
        "o_orderkey",
        fn.has_advanced(season, minimum).alias("advanced"),
        F.array_join(families, ",").alias("families"),
    )


@check(
    "F15_season_label",
    """SELECT o_orderkey, lpad(CAST(year(o_orderdate) % 100 AS string), 2, '0') ||
    lpad(CAST((year(o_orderdate) + 1) % 100 AS string), 2, '0') AS label,
    (year(o_orderdate) - 1) || '-' || year(o_orderdate) AS slug FROM orders""",
)
def season_label(spark, d):
    year = F.year("o_orderdate")
    return load(spark, d, "orders").select(
        "o_orderkey", fn.season_label(year).alias("label"), fn.season_slug(year).alias("slug")
    )


@check("F16_month_end", "SELECT o_orderkey, CAST(last_day(o_orderdate) AS string) AS month_end FROM orders")
def month_end(spark, d):
    end = fn.month_end(F.col("o_orderdate").cast("date")).cast("string")
    return load(spark, d, "orders").select("o_orderkey", end.alias("month_end"))
