"""Distinct, ordered and window-shaped operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.analogs import RESULTS
from checks.registry import check, load, run
from matchloom.operators import windows as ops

ITEM_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@check("D1_distinct_rows", "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, d):
    return ops.distinct_rows(load(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag"))


FLAGGED = """SELECT *, CASE WHEN l_tax = 0 THEN NULL ELSE l_linestatus END AS side FROM {lineitem}"""


@check(
    "D2_first_per_key",
    f"""SELECT l_orderkey, side, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, side ORDER BY {ITEM_ORDER}) AS rn FROM flagged
    WHERE side IS NOT NULL) WHERE rn = 1""",
    flagged=FLAGGED,
)
def first_per_key(spark, d):
    rows = run(spark, d, FLAGGED).drop("l_shipdate")
    first = ops.first_per_key(rows, ["l_orderkey", "side"], ["l_linenumber", "l_partkey", "l_suppkey"])
    columns = ["l_orderkey", "side", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return first.select(*columns)


SLICE = """SELECT o_orderkey AS pos, concat('u', CAST(o_custkey AS string)) AS MatchURL, o_orderpriority AS Team,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS Gls, 'X' AS Gender,
    CASE WHEN o_totalprice > 100000 THEN NULL ELSE concat('Cup', CAST(o_custkey AS string)) END AS Competition_Name,
    CAST(0 AS bigint) AS Season_End_Year FROM {orders}"""


@check(
    "D3_clean_slice",
    """SELECT pos, MatchURL, Team, Gls, Gender, Competition_Name, Season_End_Year FROM (
    SELECT pos, MatchURL, Team, COALESCE(Gls, 0) AS Gls, 'M' AS Gender,
    last_value(Competition_Name IGNORE NULLS) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS Competition_Name,
    CAST(1998 AS bigint) AS Season_End_Year, row_number() OVER (PARTITION BY MatchURL, Team ORDER BY pos) AS rn
    FROM slice) WHERE rn = 1""",
    slice=SLICE,
)
def clean_slice(spark, d):
    return ops.clean_slice(run(spark, d, SLICE), 1998, "ENG", ["pos"])


GAPS = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 120000 THEN NULL ELSE o_custkey END AS value
    FROM {orders}"""


@check(
    "W1_forward_fill",
    """SELECT o_orderkey, o_orderstatus, last_value(value IGNORE NULLS) OVER (PARTITION BY o_orderstatus
    ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS value FROM gaps""",
    gaps=GAPS,
)
def forward_fill(spark, d):
    return ops.forward_fill(run(spark, d, GAPS), "value", ["o_orderstatus"], ["o_orderkey"])


# a conversation is a page with two lists of turns; the first assistant turn is the marker of a list
TURNS = """SELECT conv_id, turn, CASE WHEN turn < 4 THEN 'Home' ELSE 'Away' END AS side,
    CASE WHEN role = 'assistant' THEN 'Bench' ELSE text END AS entry FROM {conversations}"""


@check(
    "W2_marker_split",
    """SELECT t.conv_id, t.turn, t.side, t.entry, CASE WHEN t.turn < m.first THEN 'Pitch' ELSE 'Bench' END AS Starting
    FROM turns t JOIN (SELECT conv_id, side, min(turn) FILTER (WHERE entry = 'Bench') AS first,
        FROM turns GROUP BY conv_id, side) m ON m.conv_id = t.conv_id AND m.side = t.side
    WHERE entry <> 'Bench' AND t.conv_id NOT IN (SELECT conv_id FROM turns GROUP BY conv_id, side
        HAVING count(*) FILTER (WHERE entry = 'Bench') = 0)""",
    turns=TURNS,
)
def marker_split(spark, d):
    return ops.marker_split(run(spark, d, TURNS), ["conv_id"], "side", "turn", "entry")


@check(
    "W3_dense_index",
    """SELECT l_partkey, row_number() OVER (ORDER BY first, l_partkey) - 1 AS index FROM
    (SELECT l_partkey, min(l_orderkey) AS first FROM lineitem GROUP BY l_partkey)""",
)
def dense_index(spark, d):
    return ops.dense_index(load(spark, d, "lineitem"), "l_partkey", ["l_orderkey"])


@check(
    "O1_sort_by",
    """SELECT MatchKey, Country, Season_End_Year, Notes FROM results ORDER BY Country, Season_End_Year, Notes NULLS FIRST,
    MatchKey""",
    results=RESULTS,
)
def sort_by(spark, d):
    rows = run(spark, d, RESULTS).select("MatchKey", "Country", "Season_End_Year", "Notes")
    return ops.sort_by(rows, ["Country", "Season_End_Year", "Notes", "MatchKey"])


@check(
    "O2_sort_by_present",
    "SELECT Season_End_Year, Country AS Team, MatchKey FROM results ORDER BY Season_End_Year, Team",
    results=RESULTS,
)
def sort_by_present(spark, d):
    rows = run(spark, d, RESULTS).select("Season_End_Year", F.col("Country").alias("Team"), "MatchKey")
    return ops.sort_by_present(rows)


@check(
    "O3_first_n_per_group",
    """SELECT l_orderkey, l_linestatus, string_agg(CAST(l_partkey AS string), ',' ORDER BY rn) AS players FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey)
        AS rn FROM lineitem) WHERE rn <= 3 GROUP BY l_orderkey, l_linestatus""",
)
def first_n_per_group(spark, d):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    items = load(spark, d, "lineitem")
    arrays = ops.first_n_per_group(items, ["l_orderkey", "l_linestatus"], order, "l_partkey", 3)
    players = F.array_join("l_partkeys", ",").alias("players")
    return arrays.select("l_orderkey", "l_linestatus", players)
