"""Selections, filters and repairs over whole tables."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.analogs import FAMILY_STATS, ITEM_KEYS, ITEM_MATCH_KEYS, ITEMS, RESULTS, WAGES, family_sql
from checks.registry import check, load, run, with_tables
from matchloom.functions import quoted
from matchloom.operators import cleaning as ops
from matchloom.schemas import DEFENSE_ALIASES, TEAM_KEYS, declare

LINE_TEXT = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag = 'A' THEN 'NA_character_' WHEN l_returnflag = 'N' THEN 'x NA_character_ y' ELSE 'fine' END
    AS Notes FROM {lineitem}"""


@check("P1_select_declared", "SELECT Tier, MatchURL, Country, Gender FROM results", results=RESULTS)
def select_declared(spark, d):
    fields = declare("Tier:S, MatchURL:S?, Country:S, Gender:S")
    return ops.select_declared(run(spark, d, RESULTS), fields)


@check(
    "P2_stamp",
    "SELECT MatchKey, Country, 'M' AS Gender, '1st' AS Tier, CAST(1999 AS bigint) AS Season_End_Year FROM results",
    results=RESULTS,
)
def stamp(spark, d):
    stamped = ops.stamp(run(spark, d, RESULTS), Gender="M", Tier="1st", Season_End_Year=1999)
    return stamped.select("MatchKey", "Country", "Gender", "Tier", F.col("Season_End_Year").cast("bigint"))


@check(
    "P3_rename",
    "SELECT n_name AS Country, n_nationkey AS country_key, n_regionkey AS Tier FROM nation",
)
def rename(spark, d):
    mapping = {"n_name": "Country", "n_nationkey": "country_key", "n_regionkey": "Tier", "absent": "x"}
    return ops.rename(load(spark, d, "nation"), mapping)


@check(
    "P4_entity_rows",
    """SELECT * FROM (SELECT 'Player' AS choice, Comp, Season, Team, Player, AnnualWageGBP FROM wages
    WHERE Player = 'Customer#000000007' UNION ALL SELECT 'Team', Comp, Season, Team, Player, AnnualWageGBP
    FROM wages WHERE Team = 'N7') AS t""",
    wages=WAGES,
)
def entity_rows(spark, d):
    wages = run(spark, d, WAGES)
    columns = ["Comp", "Season", "Team", "Player", "AnnualWageGBP"]
    players = ops.entity_rows(wages, "Player", "Customer#000000007").select(F.lit("Player").alias("choice"), *columns)
    return players.unionAll(ops.entity_rows(wages, "Team", "N7").select(F.lit("Team"), *columns))


@check(
    "P5_valid_matches",
    """SELECT MatchKey, MatchURL, Country FROM results WHERE MatchURL NOT LIKE '%History%'
    AND MatchURL NOT LIKE '%RelegationPromotion-Play-offs%' AND (Notes IS NULL OR Notes NOT LIKE '%Cancelled%')""",
    results=RESULTS,
)
def valid_matches(spark, d):
    return ops.valid_matches(run(spark, d, RESULTS)).select("MatchKey", "MatchURL", "Country")


SPARSE = """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax < 0.03 THEN NULL ELSE l_quantity END AS Gls,
    CASE WHEN l_discount < 0.04 THEN NULL ELSE l_linenumber END AS Ast, CAST(NULL AS string) AS Notes
    FROM {lineitem}"""


@check(
    "P6_drop_empty_stat_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, Gls, Ast FROM sparse WHERE Gls IS NOT NULL OR Ast IS NOT NULL""",
    sparse=SPARSE,
)
def drop_empty_stat_rows(spark, d):
    kept = ops.drop_empty_stat_rows(run(spark, d, SPARSE), "summary", Observation("empty-rows"))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "Gls", "Ast")


@check(
    "P7_drop_all_null_columns",
    "SELECT l_orderkey, l_linenumber, l_partkey, Gls, Ast FROM sparse",
    sparse=SPARSE,
)
def drop_all_null_columns(spark, d):
    return ops.drop_all_null_columns(run(spark, d, SPARSE))


@check("P8_drop_junk_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_junk_columns(spark, d):
    junk = load(spark, d, "supplier").select(
        F.col("s_nationkey").alias("Unnamed: 0"), "s_suppkey", F.col("s_acctbal").alias("_c2"), "s_name"
    )
    return ops.drop_junk_columns(junk)


@check(
    "P9_coalesce_aliases",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE l_tax END
    AS "Def 3rd_Tackles", l_discount AS "Tkl+Int" FROM lineitem""",
)
def coalesce_aliases(spark, d):
    quantity = F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))
    drifting = load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        quantity.alias("Def 3rd_Tackles"),
        F.col("l_tax").alias("Def.3rd_Tackles"),
        F.col("l_discount").alias("Tkl.Int"),
    )
    return ops.coalesce_aliases(drifting, DEFENSE_ALIASES)


@check(
    "P10_canonical_match_url",
    """SELECT l_orderkey, l_linenumber, l_partkey, MatchURL FROM lineitem JOIN results ON l_orderkey = MatchKey
    WHERE Gender = 'F'""",
    results=RESULTS,
)
def canonical_match_url(spark, d):
    results = run(spark, d, RESULTS).filter("Gender = 'F'")
    path = F.concat(F.lit("html/"), F.col("MatchKey").cast("string"))
    mapping = results.select(path.alias("MatchURL"), F.col("MatchURL").alias("Game_URL"))
    rows = load(spark, d, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("html/"), F.col("l_orderkey").cast("string")).alias("MatchURL"),
        "l_linenumber",
        "l_partkey",
    )
    return ops.canonical_match_url(rows, mapping)


@check(
    "P11_clean_sentinels",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'whole' AS mode, CASE Notes WHEN 'NA_character_' THEN ''
    ELSE Notes END AS Notes FROM texts UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, 'part', replace(Notes, 'NA_character_', '') FROM texts""",
    texts=LINE_TEXT,
)
def clean_sentinels(spark, d):
    texts = run(spark, d, LINE_TEXT)
    whole = ops.clean_sentinels(texts).withColumn("mode", F.lit("whole"))
    return whole.unionByName(ops.clean_sentinels(texts, "substring").withColumn("mode", F.lit("part")))


DIRTY = """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'x'
    ELSE CAST(o_custkey AS string) END AS Home_Score, CASE WHEN o_orderstatus = 'P' THEN NULL
    ELSE CAST(CAST(o_orderdate AS date) AS string) END AS Match_Date FROM {orders}"""
FIELDS = declare("o_orderkey:L, Match_Date:DT, Home_Score:L=0")


@check(
    "P12_conform",
    """SELECT o_orderkey, TRUE AS good, CAST(COALESCE(TRY_CAST(Home_Score AS bigint), 0) AS bigint) AS score,
    Match_Date AS day, '' AS why FROM dirty WHERE Match_Date IS NOT NULL AND COALESCE(Home_Score, '0') <> 'x'
    UNION ALL SELECT o_orderkey, FALSE, NULL, Match_Date, CASE WHEN Match_Date IS NULL THEN 'Match_Date: null' ELSE ''
    END || CASE WHEN Match_Date IS NULL AND Home_Score = 'x' THEN ',' ELSE '' END || CASE WHEN Home_Score = 'x'
    THEN 'Home_Score: type' ELSE '' END FROM dirty WHERE Match_Date IS NULL OR Home_Score = 'x'""",
    dirty=DIRTY,
)
def conform(spark, d):
    good, refused = ops.conform(run(spark, d, DIRTY), FIELDS)
    a = good.select(
        "o_orderkey",
        F.lit(True).alias("good"),
        F.col("Home_Score").alias("score"),
        F.col("Match_Date").cast("string").alias("day"),
        F.lit("").alias("why"),
    )
    b = refused.select(
        "o_orderkey",
        F.lit(False),
        F.lit(None).cast("bigint"),
        "Match_Date",
        F.array_join("violations", ","),
    )
    return a.unionAll(b)


@check(
    "P13_fill_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(Gls, 0) AS Gls, COALESCE(Ast, 0) AS Ast, Notes FROM sparse""",
    sparse=SPARSE,
)
def fill_numeric(spark, d):
    return ops.fill_numeric(run(spark, d, SPARSE))


@check(
    "P14_frames_differ",
    """SELECT Country, Gender, Tier, count(*) FILTER (WHERE MatchURL IS NULL) AS changed FROM results
    GROUP BY Country, Gender, Tier HAVING count(*) FILTER (WHERE MatchURL IS NULL) > 0""",
    results=RESULTS,
)
def frames_differ(spark, d):
    before = run(spark, d, RESULTS).select("Country", "Gender", "Tier", "MatchURL")
    after = before.na.fill("", subset=["MatchURL"])
    gone = ops.frame_difference(before, after).filter("surplus > 0")
    return gone.groupBy("Country", "Gender", "Tier").agg(F.sum("surplus").cast("bigint").alias("changed"))


@check(
    "P14_fingerprints",
    """SELECT Country, Gender, Tier, count(*) AS rows, count(*) FILTER (WHERE MatchURL IS NULL) > 0 AS changed FROM results
    GROUP BY Country, Gender, Tier""",
    results=RESULTS,
)
def fingerprints(spark, d):
    keys = ["Country", "Gender", "Tier"]
    before = run(spark, d, RESULTS).select(*keys, "MatchURL", F.create_map(F.lit("season"), "Season_End_Year").alias("more"))
    after = ops.fingerprints(before.na.fill("", subset=["MatchURL"]).repartition(5), keys)
    marked = ops.fingerprints(before, keys).withColumn("side", F.lit(0)).unionByName(after.withColumn("side", F.lit(1)))
    both = marked.groupBy(*keys).agg(F.max("rows").alias("rows"), F.countDistinct("rows", "sum_1", "sum_2").alias("kinds"))
    return both.select(*keys, "rows", (F.col("kinds") > 1).alias("changed"))


@check(
    "P15_fix_team_names",
    """SELECT MatchKey, Country, CASE WHEN Country = 'NATION_4' THEN replace(MatchURL, 'History', 'Past-Games')
    ELSE MatchURL END AS MatchURL FROM results""",
    results=RESULTS,
)
def fix_team_names(spark, d):
    fixed = ops.fix_team_names(run(spark, d, RESULTS), {"NATION_4": {"History": "Past-Games"}})
    return fixed.select("MatchKey", "Country", "MatchURL")


_KEYS = ", ".join(k for k in TEAM_KEYS if k in ITEM_KEYS)
_MATCH = ", ".join(k for k in ITEM_MATCH_KEYS if k not in TEAM_KEYS)


@check(
    "P16_select_stat_columns",
    with_tables(
        f"""SELECT DISTINCT {_KEYS}, {_MATCH.replace("Match_Date", "CAST(Match_Date AS string) AS Match_Date")}, "Int", "Tkl+Int", "Def 3rd_Tackles" FROM defense""",
        items=ITEMS,
        defense=family_sql("defense", "duckdb"),
    ),
)
def select_stat_columns(spark, d):
    items = run(spark, d, ITEMS)
    rows = run(spark, d, family_sql("defense", "spark"), items=items)
    text = rows.withColumns({c: quoted(c).cast("string") for c in FAMILY_STATS["defense"]})
    keys = [k for k in TEAM_KEYS if k in ITEM_KEYS]
    chosen = ops.select_stat_columns(text, "defense", "team", keys, ITEM_MATCH_KEYS)
    return chosen.withColumn("Match_Date", F.col("Match_Date").cast("string"))

