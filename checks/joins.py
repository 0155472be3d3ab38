"""Joins over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.analogs import (
    ADVANCED_KEYS,
    CONFIG,
    FAMILY_STATS,
    ITEMS,
    RESULTS,
    SUMMARY_KEYS,
    TEAM_KEYS_SEEN,
    family_sql,
)
from checks.registry import check, load, run
from matchloom.operators import joins as ops
from matchloom.operators.cleaning import key_coverage, valid_matches
from matchloom.schemas import FAMILIES
from matchloom.session import materialize

KEY_SETS = {"summary": SUMMARY_KEYS, "team_summary": TEAM_KEYS_SEEN, "team_advanced": ADVANCED_KEYS}


def key_sets(spark, d, results):
    dealt = ops.in_tasks(results, "MatchKey", 4 * spark.sparkContext.defaultParallelism)
    return {n: run(spark, d, sql.replace("DISTINCT", ""), results=dealt) for n, sql in KEY_SETS.items()}


@check(
    "J1_with_league_config",
    """SELECT MatchKey, r.Country, r.Tier, Season_End_Year, Min_Advanced_Season FROM results r JOIN config c
    ON r.Country = c.Country AND r.Tier = c.Tier WHERE Season_End_Year >= 1997 AND Gender = 'F'""",
    results=RESULTS,
    config=CONFIG,
)
def with_league_config(spark, d):
    results = run(spark, d, RESULTS)
    joined = ops.with_league_config(results, "F", run(spark, d, CONFIG, results=results), 1997)
    return joined.select("MatchKey", "Country", "Tier", "Season_End_Year", "Min_Advanced_Season")


@check(
    "J2_with_presence_flags",
    """SELECT MatchKey, EXISTS (SELECT 1 FROM a WHERE a.MatchURL = r.MatchURL) AS in_summary,
    EXISTS (SELECT 1 FROM b WHERE b.MatchURL = r.MatchURL) AS in_team FROM results r""",
    results=RESULTS,
    a=SUMMARY_KEYS,
    b=TEAM_KEYS_SEEN,
)
def with_presence_flags(spark, d):
    results = run(spark, d, RESULTS)
    sets = key_sets(spark, d, results)
    flagged = ops.with_presence_flags(results, in_summary=sets["summary"], in_team=sets["team_summary"])
    return flagged.select("MatchKey", "in_summary", "in_team")


@check(
    "J3_missing_matches",
    """SELECT MatchKey, r.MatchURL, 'stage/html/' || r.Country || '/' || split_part(r.MatchURL, '/', 7) || '.html'
    AS filename FROM results r JOIN config c ON r.Country = c.Country AND r.Tier = c.Tier
    LEFT JOIN a ON a.MatchURL = r.MatchURL LEFT JOIN b ON b.MatchURL = r.MatchURL
    LEFT JOIN e ON e.MatchURL = r.MatchURL
    WHERE Gender = 'F' AND Season_End_Year >= 1996 AND r.MatchURL NOT LIKE '%History%'
    AND r.MatchURL NOT LIKE '%RelegationPromotion-Play-offs%' AND COALESCE(Notes, '') NOT LIKE '%Cancelled%'
    AND (a.MatchURL IS NULL OR b.MatchURL IS NULL
        OR (e.MatchURL IS NULL AND COALESCE(Season_End_Year >= Min_Advanced_Season, FALSE)))""",
    results=RESULTS,
    config=CONFIG,
    a=SUMMARY_KEYS,
    b=TEAM_KEYS_SEEN,
    e=ADVANCED_KEYS,
)
def missing_matches(spark, d):
    results = run(spark, d, RESULTS)
    config = run(spark, d, CONFIG, results=results)
    sets = key_sets(spark, d, results)
    missing = ops.missing_matches(results, **sets, gender="F", config=config, first_season=1996)
    return missing.select("MatchKey", "MatchURL", "filename")


@check(
    "J4_attach_league_by_match_id",
    """SELECT l_orderkey, l_linenumber, l_partkey, MatchURL, Country, Gender, Tier, Season_End_Year
    FROM lineitem LEFT JOIN (SELECT * FROM results WHERE Gender <> 'P' AND MatchURL IS NOT NULL) r
    ON l_orderkey = MatchKey""",
    results=RESULTS,
)
def attach_league_by_match_id(spark, d):
    matches = run(spark, d, RESULTS).filter("Gender <> 'P'")
    league = matches.select("MatchURL", "Country", "Tier", "Season_End_Year", "Gender")
    own = F.concat(F.lit("file/x/"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0"), F.lit("/other"))
    stats = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", own.alias("MatchURL"))
    return ops.attach_league_by_match_id(stats, league)


@check(
    "J5_attach_league",
    """SELECT l_orderkey, l_linenumber, l_partkey, r.MatchURL, l_returnflag AS Tier, m.Country FROM lineitem
    JOIN results r ON l_orderkey = r.MatchKey LEFT JOIN (SELECT MatchURL, Country FROM results WHERE Gender <> 'P') m
    ON m.MatchURL = r.MatchURL""",
    results=RESULTS,
)
def attach_league(spark, d):
    results = run(spark, d, RESULTS)
    rows = run(
        spark,
        d,
        """SELECT l_orderkey, l_linenumber, l_partkey, MatchURL, l_returnflag AS Tier FROM {lineitem}
        JOIN {results} ON l_orderkey = MatchKey""",
        results=results,
    )
    return ops.attach_league(rows, results.filter("Gender <> 'P'").select("MatchURL", "Country", "Tier"))


COMPETITIONS = """SELECT n_name AS Competition_Name, substr(r_name, 1, 2) AS Country, 'M' AS Gender,
    CAST(n_regionkey AS string) AS Tier, n_nationkey AS season FROM {nation} JOIN {region}
    ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'"""


@check(
    "J6_league_from_competition",
    """SELECT MatchKey, r.Country AS League, c.Country, c.Gender, c.Tier, r.Country AS Competition_Name
    FROM results r LEFT JOIN competitions c ON r.Country = c.Competition_Name""",
    results=RESULTS,
    competitions=COMPETITIONS,
)
def league_from_competition(spark, d):
    summary = run(spark, d, RESULTS).select("MatchKey", F.col("Country").alias("League"))
    return ops.league_from_competition(summary, run(spark, d, COMPETITIONS))


# the families by team and match, with a key that may be null
SHORT_KEYS = ["MatchURL", "Team", "Home_Away", "Home_Formation"]


def staged_items(spark, d):
    """The items all families are made of, joined and written once."""
    return materialize(run(spark, d, ITEMS), "items", "zstd")


def short_families(spark, d):
    items = staged_items(spark, d)
    return {
        f: run(spark, d, family_sql(f, "spark"), items=items).select(
            *SHORT_KEYS, *[F.col(f"`{c}`") for c in FAMILY_STATS[f]]
        )
        for f in FAMILIES
    }


def own_stats() -> dict[str, list[str]]:
    """The statistics each family supplies: a name belongs to the first that has it."""
    seen: set[str] = set()
    own = {}
    for f in FAMILIES:
        own[f] = [c for c in FAMILY_STATS[f] if c not in seen]
        seen.update(own[f])
    return own


def full_join(keys, families=FAMILIES) -> str:
    def part(f):
        columns = ", ".join([*keys, *[f'"{c}"' for c in own_stats()[f]]])
        return f"(SELECT {'' if f == FAMILIES[0] else 'DISTINCT '}{columns} FROM {f}) AS t_{f}"

    using = ", ".join(keys)
    joined = part(families[0])
    for f in families[1:]:
        joined += f" FULL JOIN {part(f)} USING ({using})"
    return joined


FAMILY_TABLES = {"items": ITEMS, **{f: family_sql(f, "duckdb") for f in FAMILIES}}
ALL_STATS = [c for f in FAMILIES for c in own_stats()[f]]


@check(
    "J7_join_families",
    f"""SELECT {", ".join(SHORT_KEYS)}, {", ".join(f'"{c}"' for f in FAMILIES for c in own_stats()[f])}
    FROM {full_join(SHORT_KEYS)}""",
    **FAMILY_TABLES,
)
def join_families(spark, d):
    return ops.join_families(short_families(spark, d), SHORT_KEYS)


@check(
    "J7_A1_collapse_families",
    f"""SELECT MatchURL, Team, Home_Away, {", ".join(f'max("{c}") AS "{c}"' for c in ALL_STATS)}
    FROM (SELECT * FROM {full_join(SHORT_KEYS)}) GROUP BY MatchURL, Team, Home_Away""",
    **FAMILY_TABLES,
)
def collapse_families(spark, d):
    group = ["MatchURL", "Team", "Home_Away"]
    return ops.collapse_families(short_families(spark, d), SHORT_KEYS, group, drop=["Home_Formation"])


PLACES = """SELECT l_orderkey AS match_id, CASE WHEN l_linestatus = 'O' THEN 'Home' ELSE 'Away' END AS Side,
    concat('T', CAST(l_suppkey AS string)) AS Team, concat('P', CAST(l_partkey AS string)) AS Player_Name,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS string) END AS Player_Num,
    l_shipdate, l_quantity FROM {lineitem}"""
PLAYER_STATS = """SELECT match_id, Team, Player_Name AS Player, Player_Num, Side AS Home_Away,
    CAST(max(l_quantity) AS bigint) AS Gls FROM {places} WHERE l_quantity > 20
    GROUP BY match_id, Team, Player_Name, Player_Num, Side"""


@check(
    "J8_lineup_with_stats",
    """SELECT p.Team, COALESCE(s.Home_Away, p.Side) AS Home_Away, p.Player_Num, p.Player_Name, p.match_id, p.Side AS
    Place, p.l_quantity AS minutes, s.Gls FROM places p LEFT JOIN stats s ON p.match_id = s.match_id
    AND p.Team = s.Team AND p.Player_Name = s.Player AND p.Player_Num = s.Player_Num""",
    places=PLACES,
    stats=PLAYER_STATS.replace("{places}", "places"),
)
def lineup_with_stats(spark, d):
    places = run(spark, d, PLACES)
    stats = run(spark, d, PLAYER_STATS, places=places)
    lineup = places.select(
        "match_id",
        F.col("Side").alias("Place"),
        "Team",
        "Player_Name",
        "Player_Num",
        F.col("l_quantity").alias("minutes"),
    )
    on = ["match_id", "Team", "Player_Name", "Player_Num"]
    return ops.lineup_with_stats(lineup, stats, on, F.col("Place"))


@check(
    "J9_key_coverage",
    """SELECT DISTINCT Country, Tier, MatchURL, 'lost' AS change FROM results WHERE MatchURL IS NOT NULL
    AND (MatchURL LIKE '%History%' OR MatchURL LIKE '%RelegationPromotion-Play-offs%' OR Notes LIKE '%Cancelled%')""",
    results=RESULTS,
)
def lost_keys(spark, d):
    results = run(spark, d, RESULTS)
    return key_coverage(results, valid_matches(results), ["Country", "Tier", "MatchURL"])


@check(
    "J10_orphans",
    """SELECT MatchKey, MatchURL FROM results WHERE MatchURL IS NOT NULL AND MatchURL NOT IN (SELECT MatchURL FROM a
    WHERE MatchURL IS NOT NULL)""",
    results=RESULTS,
    a=SUMMARY_KEYS,
)
def orphans(spark, d):
    results = run(spark, d, RESULTS)
    loaded = run(spark, d, SUMMARY_KEYS, results=results)
    return ops.orphans(results.select("MatchKey", "MatchURL"), loaded, "MatchURL")


@check(
    "J11_completeness_grid",
    """SELECT c.Country, t.Tier, s.Season_End_Year, EXISTS (SELECT 1 FROM results r WHERE r.Country = c.Country
    AND r.Tier = t.Tier AND r.Season_End_Year = s.Season_End_Year) AS present
    FROM (SELECT DISTINCT Country FROM results) c, (SELECT DISTINCT Tier FROM results) t,
    (SELECT DISTINCT Season_End_Year FROM results) s""",
    results=RESULTS,
)
def completeness_grid(spark, d):
    return ops.completeness_grid(run(spark, d, RESULTS), ["Country", "Tier", "Season_End_Year"])


SIDES = """SELECT l_orderkey AS match_id, count(*) AS players, CAST(sum(l_linenumber) AS bigint) AS numbers
    FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey"""


@check(
    "J12_matches_with_lineups",
    """SELECT o_orderkey AS match_id, o_custkey AS home, players, numbers FROM orders
    LEFT JOIN sides ON o_orderkey = match_id""",
    sides=SIDES,
)
def matches_with_lineups(spark, d):
    matches = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("match_id"), F.col("o_custkey").alias("home")
    )
    return ops.matches_with_lineups(matches, run(spark, d, SIDES))


@check(
    "J13_broadcast_match_header",
    """SELECT o_orderkey AS page_id, l_linenumber, l_partkey, o_custkey, o_orderstatus FROM lineitem JOIN orders
    ON l_orderkey = o_orderkey""",
)
def broadcast_match_header(spark, d):
    header = load(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), "o_custkey", "o_orderstatus")
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("page_id"), "l_linenumber", "l_partkey")
    return ops.broadcast_match_header(header, rows)


FIXTURES = """SELECT c_nationkey AS home, s_nationkey AS away, CAST(sum(l_quantity) AS bigint) AS goals
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
    JOIN {supplier} ON l_suppkey = s_suppkey GROUP BY c_nationkey, s_nationkey"""
TEAMS = """SELECT n_nationkey AS team, (n_nationkey - 12) / 50.0E0 AS attack, (n_regionkey - 2) / 20.0E0 AS defence
    FROM {nation}"""


@check(
    "J14_ordered_pairs",
    """SELECT home, away, goals, h.attack AS home_attack, h.defence AS home_defence, a.attack AS away_attack,
    a.defence AS away_defence FROM fixtures JOIN teams h ON h.team = home JOIN teams a ON a.team = away
    WHERE home <> away""",
    fixtures=FIXTURES,
    teams=TEAMS,
)
def ordered_pairs(spark, d):
    return ops.ordered_pairs(run(spark, d, FIXTURES), run(spark, d, TEAMS))


CLUBS = """SELECT s_suppkey AS team, s_nationkey / 50.0E0 AS attack, (s_nationkey - 12) / 20.0E0 AS defence FROM {supplier}"""
MET = """SELECT l_suppkey AS home, 1 + l_partkey % 10 AS away, CAST(sum(l_linenumber) AS bigint) AS goals
    FROM {lineitem} GROUP BY l_suppkey, 1 + l_partkey % 10"""


@check(
    "J14_all_pairs",
    """SELECT h.team AS home, a.team AS away, goals, h.attack AS home_attack, h.defence AS home_defence,
    a.attack AS away_attack, a.defence AS away_defence FROM teams h JOIN teams a ON h.team <> a.team
    LEFT JOIN fixtures ON home = h.team AND away = a.team""",
    fixtures=MET,
    teams=CLUBS,
)
def all_pairs(spark, d):
    return ops.all_pairs(run(spark, d, CLUBS), run(spark, d, MET))
