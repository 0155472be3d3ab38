"""Aggregates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.analogs import RESULTS, SUMMARY_KEYS, WAGES
from checks.registry import check, load, run
from matchloom.operators import aggregates as ops
from matchloom.session import work_folder
from matchloom.streaming import profiles

STATS = """SELECT l_orderkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS num,
    CASE WHEN l_tax > 0.04 THEN NULL ELSE l_quantity END AS Gls, l_returnflag AS Pos, l_discount AS xG
    FROM {lineitem}"""


@check(
    "A1_collapse",
    """SELECT l_orderkey, num, max(l_suppkey) AS l_suppkey, max(Gls) AS Gls, max(Pos) AS Pos, max(xG) AS xG
    FROM stats GROUP BY l_orderkey, num""",
    stats=STATS,
)
def collapse(spark, d):
    return ops.collapse(run(spark, d, STATS), ["l_orderkey", "num"])


@check(
    "A2_wage_totals",
    """SELECT Comp, Team, Season, COALESCE(sum(WeeklyWageGBP), 0) AS TotalWages, avg(WeeklyWageGBP) AS AvgWages FROM wages GROUP BY Comp, Team, Season""",
    wages=WAGES,
)
def wage_totals(spark, d):
    return ops.wage_totals(run(spark, d, WAGES))


@check(
    "A3_counts_by",
    """SELECT 'rows' AS kind, Country, Tier, count(*) AS len FROM results GROUP BY Country, Tier
    UNION ALL SELECT 'distinct', Country, Tier, count(DISTINCT Date) FROM results GROUP BY Country, Tier""",
    results=RESULTS,
)
def counts_by(spark, d):
    results = run(spark, d, RESULTS)
    rows = ops.counts_by(results, ["Country", "Tier"]).select(F.lit("rows").alias("kind"), "*")
    return rows.unionAll(ops.counts_by(results, ["Country", "Tier"], ["Date"]).select(F.lit("distinct"), "*"))


@check(
    "A4_null_profile",
    """SELECT Country, Gender, Tier, avg(CASE WHEN MatchURL IS NULL THEN 1 ELSE 0 END) AS MatchURL,
    avg(CASE WHEN Notes IS NULL THEN 1 ELSE 0 END) AS Notes,
    avg(CASE WHEN Date IS NULL THEN 1 ELSE 0 END) AS Date FROM results GROUP BY Country, Gender, Tier""",
    results=RESULTS,
)
def null_profile(spark, d):
    rows = run(spark, d, RESULTS).select("Country", "Gender", "Tier", "MatchURL", "Notes", "Date")
    return ops.null_profile(rows, ["Country", "Gender", "Tier"])


@check(
    "A4_profile_of_batches",
    """SELECT Country, Gender, Tier, count(*) AS rows, round(avg(CASE WHEN MatchURL IS NULL THEN 1 ELSE 0 END), 6) AS MatchURL,
    round(avg(CASE WHEN Notes IS NULL OR month(Date) > 8 THEN 1 ELSE 0 END), 6) AS Notes,
    round(avg(CASE WHEN Date IS NULL THEN 1 ELSE 0 END), 6) AS Date FROM results GROUP BY Country, Gender, Tier""",
    results=RESULTS,
)
def profile_of_batches(spark, d):
    rows = run(spark, d, RESULTS).select("Country", "Gender", "Tier", "MatchURL", "Notes", "Date")
    base, state = work_folder(spark, "batches"), work_folder(spark, "profile")
    month = F.coalesce(F.month("Date"), F.lit(1))
    # the last batch does not have one of the columns
    batches = [rows.filter(month <= 4), rows.filter((month > 4) & (month <= 8)), rows.filter(month > 8).drop("Notes")]
    for n, batch in enumerate(batches, 1):
        batch.write.parquet(f"{base}/batch={n:04d}")
        if profiles.update_profile(spark, base, state, ["Country", "Gender", "Tier"], "MatchURL") != [n]:
            raise ValueError("an old batch was read again")
    found = profiles.read_profile(spark, state, ["Country", "Gender", "Tier"])
    return found.select("Country", "Gender", "Tier", "rows", *[F.round(c, 6).alias(c) for c in ("MatchURL", "Notes", "Date")])


@check(
    "A5_null_profile_summary",
    """SELECT Country, Gender, Tier, round(min(share), 6) AS Min, round(max(share), 6) AS Max,
    round(avg(share), 6) AS Avg FROM (UNPIVOT (SELECT Country, Gender, Tier,
        avg(CASE WHEN MatchURL IS NULL THEN 1 ELSE 0 END) AS MatchURL,
        avg(CASE WHEN Notes IS NULL THEN 1 ELSE 0 END) AS Notes,
        avg(CASE WHEN Date IS NULL THEN 1 ELSE 0 END) AS Date FROM results GROUP BY Country, Gender, Tier)
        ON MatchURL, Notes, Date INTO NAME part VALUE share) GROUP BY Country, Gender, Tier""",
    results=RESULTS,
)
def null_profile_summary(spark, d):
    rows = run(spark, d, RESULTS).select("Country", "Gender", "Tier", "MatchURL", "Notes", "Date")
    summary = ops.null_profile_summary(rows, ["Country", "Gender", "Tier"])
    return summary.withColumns({c: F.round(c, 6) for c in ("Min", "Max", "Avg")})


@check(
    "A6_share_true",
    """SELECT 'day' AS bucket, CAST(Date AS string) AS Date, avg(CASE WHEN MatchURL LIKE '%History%' THEN 0
    WHEN MatchURL IS NULL THEN NULL ELSE 1 END) AS share FROM results GROUP BY Date
    UNION ALL SELECT 'month', CAST(last_day(Date) AS string), avg(CASE WHEN MatchURL LIKE '%History%' THEN 0
    WHEN MatchURL IS NULL THEN NULL ELSE 1 END) FROM results GROUP BY last_day(Date)""",
    results=RESULTS,
)
def share_true(spark, d):
    results = run(spark, d, RESULTS)
    correct = ~F.col("MatchURL").contains("History")
    parts = [
        ops.share_true(results, correct, F.col("Date"), b).select(
            F.lit(b).alias("bucket"), F.col("Date").cast("string").alias("Date"), "share"
        )
        for b in ("day", "month")
    ]
    return parts[0].unionAll(parts[1])


@check(
    "A7_n_unique",
    """SELECT count(DISTINCT MatchURL) + max(CASE WHEN MatchURL IS NULL THEN 1 ELSE 0 END) AS n_unique FROM results
    WHERE Season_End_Year = 1998""",
    results=RESULTS,
)
def n_unique(spark, d):
    return ops.n_unique(run(spark, d, RESULTS), "MatchURL", F.col("Season_End_Year") == 1998)


@check(
    "A8_entity_catalog",
    """SELECT Country FROM (SELECT n_name AS Country FROM nation UNION SELECT r_name FROM region
    UNION SELECT c_mktsegment FROM customer)""",
)
def entity_catalog(spark, d):
    tables = {
        "nation": load(spark, d, "nation").select(F.col("n_name").alias("Country")),
        "region": load(spark, d, "region").select(F.col("r_name").alias("Country"), "r_regionkey"),
        "part": load(spark, d, "part"),
        "customer": load(spark, d, "customer").select("c_name", F.col("c_mktsegment").alias("Country")),
    }
    return ops.entity_catalog(tables, "Country")


FILES = """SELECT r_name AS country, CAST(year(o_orderdate) AS bigint) AS year, o_orderstatus AS stat,
    substr(o_orderpriority, 1, 1) AS tier FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@check(
    "A9_coverage_pivot",
    f"""SELECT year, {", ".join(f"count(*) FILTER (WHERE country = '{r}') AS \"{r}\"" for r in REGIONS)}
    FROM files WHERE stat = 'F' AND tier = '1' GROUP BY year""",
    files=FILES,
)
def coverage_pivot(spark, d):
    return ops.coverage_pivot(run(spark, d, FILES), "F", "1", REGIONS)


@check(
    "A10_wage_history",
    """SELECT 'team' AS choice, Season, Player AS name, sum(AnnualWageGBP) AS AnnualWageGBP FROM wages
    WHERE Team = 'N3' GROUP BY Season, Player UNION ALL SELECT 'player', Season, Team, sum(AnnualWageGBP)
    FROM wages WHERE Player = 'Customer#000000010' GROUP BY Season, Team""",
    wages=WAGES,
)
def wage_history(spark, d):
    wages = run(spark, d, WAGES)
    team = ops.wage_history(wages, "Team", "N3", "Player").withColumnRenamed("Player", "name")
    player = ops.wage_history(wages, "Player", "Customer#000000010", "Team").withColumnRenamed("Team", "name")
    return team.select(F.lit("team").alias("choice"), "*").unionAll(player.select(F.lit("player"), "*"))


CAREERS = """SELECT p_name AS Player, CAST(year(l_shipdate) AS bigint) AS Season_End_Year,
    CAST(sum(l_quantity) AS bigint) AS Gls, count(*) AS Ast FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
    GROUP BY p_name, year(l_shipdate)"""


@check(
    "A11_player_career",
    "SELECT Season_End_Year, Gls, Ast FROM careers WHERE Player = 'red widget'",
    careers=CAREERS,
)
def player_career(spark, d):
    return ops.player_career(run(spark, d, CAREERS), "red widget", ["Gls", "Ast"])


@check(
    "A12_load_progress",
    """SELECT r.Country, r.Tier, r.Season_End_Year, count(DISTINCT r.MatchURL) AS expected,
    count(DISTINCT a.MatchURL) AS loaded, count(DISTINCT r.MatchURL) - count(DISTINCT a.MatchURL) AS remaining
    FROM results r LEFT JOIN a ON a.MatchURL = r.MatchURL WHERE r.MatchURL NOT LIKE '%History%'
    AND r.MatchURL NOT LIKE '%RelegationPromotion-Play-offs%' AND COALESCE(Notes, '') NOT LIKE '%Cancelled%'
    GROUP BY r.Country, r.Tier, r.Season_End_Year""",
    results=RESULTS,
    a=SUMMARY_KEYS,
)
def load_progress(spark, d):
    results = run(spark, d, RESULTS)
    summary = run(spark, d, SUMMARY_KEYS.replace("DISTINCT", ""), results=results)
    return ops.load_progress(results, summary, ["Country", "Tier", "Season_End_Year"])
