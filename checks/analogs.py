"""Match-shaped inputs made of the given tables, in SQL both engines read."""

from __future__ import annotations

URL = "concat('https://x.test/en/matches/', lpad(CAST({key} AS string), 8, '0'), '/', {kind}, '-', CAST({key} AS string))"
ORDER_URL = URL.format(key="o_orderkey", kind="'Match'")

# results: one row per order; head-to-head pages, play-offs, cancelled and missing URLs by price
RESULTS = (
    "SELECT o_orderkey AS MatchKey, CASE WHEN o_totalprice < 5000 THEN NULL ELSE "
    + URL.format(
        key="o_orderkey",
        kind="CASE WHEN o_totalprice < 20000 THEN 'History' WHEN o_totalprice < 40000"
        " THEN 'RelegationPromotion-Play-offs' ELSE 'Match' END",
    )
    + """ END AS MatchURL,
    n_name AS Country, o_orderstatus AS Gender, substr(o_orderpriority, 1, 1) AS Tier,
    CAST(o_orderdate AS date) AS Date,
    CASE WHEN o_totalprice > 480000 THEN 'Match Cancelled' WHEN o_orderstatus = 'P' THEN NULL ELSE '' END AS Notes,
    CAST(CASE WHEN month(o_orderdate) <= 7 THEN year(o_orderdate) ELSE year(o_orderdate) + 1 END AS bigint)
        AS Season_End_Year
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""
)

# leagues seen in the results; some are not followed, some have no advanced statistics
CONFIG = """SELECT DISTINCT Country, Tier,
    CASE WHEN Tier = '5' THEN NULL ELSE 1995 + CAST(Tier AS bigint) END AS Min_Advanced_Season
    FROM {results} WHERE NOT (Tier = '4' AND Country LIKE '%2')"""

# URLs of orders with a returned, an open and a discounted item
SUMMARY_KEYS = """SELECT DISTINCT MatchURL FROM {results} JOIN {lineitem} ON l_orderkey = MatchKey
    WHERE l_returnflag = 'R'"""
TEAM_KEYS_SEEN = """SELECT DISTINCT MatchURL FROM {results} JOIN {lineitem} ON l_orderkey = MatchKey
    WHERE l_linestatus = 'O'"""
ADVANCED_KEYS = """SELECT DISTINCT MatchURL FROM {results} JOIN {lineitem} ON l_orderkey = MatchKey
    WHERE l_discount >= 0.05"""

# pay in pence: sums of whole numbers are exact, in whatever order they are taken
WAGES = """SELECT c_mktsegment AS Comp, CAST(year(o_orderdate) AS bigint) AS Season,
    concat('N', CAST(c_nationkey AS string)) AS Team, c_name AS Player,
    CASE WHEN o_orderstatus = 'P' AND c_nationkey = 3 THEN NULL ELSE round(o_totalprice * 100) END
    AS WeeklyWageGBP, round(o_totalprice * 100) * 52 AS AnnualWageGBP
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""

# one row per line item with the keys of a player row
ITEMS = """SELECT concat('https://x.test/en/matches/', CAST(l_orderkey AS string), '/M') AS MatchURL,
    concat('T', CAST(l_suppkey AS string)) AS Team,
    CASE WHEN l_linestatus = 'O' THEN 'Home' ELSE 'Away' END AS Home_Away,
    concat('P', CAST(l_partkey AS string)) AS Player,
    concat('/p/', CAST(l_partkey AS string)) AS Player_Href,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS string) END AS Player_Num,
    l_returnflag AS Pos, 'ENG' AS Nation, CAST(l_linenumber + 20 AS string) AS Age,
    CAST(l_quantity AS double) AS Min,
    o_orderstatus AS Gender, l_returnflag AS Country, substr(o_orderpriority, 1, 1) AS Tier,
    CAST(CASE WHEN month(o_orderdate) <= 7 THEN year(o_orderdate) ELSE year(o_orderdate) + 1 END AS bigint)
        AS Season_End_Year,
    CAST(o_orderdate AS date) AS Match_Date,
    'L' AS League, CAST(month(o_orderdate) AS string) AS Matchweek,
    concat('C', CAST(o_custkey AS string)) AS Home_Team,
    CASE WHEN o_totalprice < 100000 THEN NULL ELSE '4-3-3' END AS Home_Formation,
    CAST(year(o_orderdate) - 1990 AS bigint) AS Home_Score, CAST(o_totalprice AS double) AS Home_xG,
    l_quantity, l_extendedprice, l_discount, l_tax, l_partkey, l_suppkey, l_linenumber
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
ITEM_KEYS = """MatchURL Team Home_Away Player Player_Href Player_Num Pos Nation Age Min Gender Country Tier
    Season_End_Year Match_Date League Matchweek Home_Team Home_Formation Home_Score Home_xG""".split()
ITEM_MATCH_KEYS = """Country Gender Tier Season_End_Year MatchURL Match_Date League Matchweek Home_Team Home_Formation
    Home_Score Home_xG""".split()

# statistics and rows of each family; some columns occur in two families with unlike values
_FAMILY = {
    "summary": (
        "CAST(l_quantity AS bigint) AS Gls, CAST(l_linenumber AS bigint) AS Ast, CAST(l_suppkey AS bigint) AS \"Int\","
        " CAST(l_partkey AS bigint) AS CrdY, l_extendedprice AS xG_Expected",
        "l_quantity > 5",
    ),
    "keeper": (
        "CAST(l_partkey + l_suppkey AS bigint) AS SoTA_Shot_Stopping, l_tax AS Save_percent_Shot_Stopping",
        "Pos = 'A'",
    ),
    "passing": (
        "CAST(l_quantity * 2 AS bigint) AS Att, CAST(l_partkey AS bigint) AS Ast, l_discount AS Cmp_percent_Total",
        "l_discount >= 0.03",
    ),
    "passing_types": (
        "CAST(l_linenumber AS bigint) AS Att, CAST(l_suppkey AS bigint) AS CK_Pass_Types",
        "l_tax >= 0.02",
    ),
    "possession": ("CAST(l_partkey * 3 AS bigint) AS Touches_Touches, l_tax AS Succ_percent_Take_Ons", "l_quantity > 25"),
    "defense": (
        "CAST(l_linenumber * 7 AS bigint) AS \"Int\", CAST(l_suppkey AS bigint) AS \"Tkl+Int\","
        " CAST(l_partkey AS bigint) AS \"Def 3rd_Tackles\"",
        "Home_Away = 'Home'",
    ),
    "misc": ("CAST(l_linenumber * 9 AS bigint) AS CrdY, CAST(l_quantity AS bigint) AS Fls", "l_discount < 0.08"),
}
FAMILY_STATS = {
    "summary": ["Gls", "Ast", "Int", "CrdY", "xG_Expected"],
    "keeper": ["SoTA_Shot_Stopping", "Save_percent_Shot_Stopping"],
    "passing": ["Att", "Ast", "Cmp_percent_Total"],
    "passing_types": ["Att", "CK_Pass_Types"],
    "possession": ["Touches_Touches", "Succ_percent_Take_Ons"],
    "defense": ["Int", "Tkl+Int", "Def 3rd_Tackles"],
    "misc": ["CrdY", "Fls"],
}


def family_sql(family: str, dialect: str) -> str:
    """The rows of one family; identifiers are quoted as the engine wants."""
    stats, where = _FAMILY[family]
    if dialect == "spark":
        stats = stats.replace('"', "`")
    keys = ", ".join(ITEM_KEYS)
    return f"SELECT {keys}, {stats} FROM {{items}} WHERE {where}"
