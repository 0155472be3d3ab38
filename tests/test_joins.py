"""Joins on small frames, and families joined or stacked."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.operators import joins as ops
from matchloom.operators.cleaning import key_coverage
from matchloom.operators.aggregates import collapse, n_unique, null_profile, null_profile_summary, wage_totals

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.one_of(st.none(), st.integers(0, 2))
ROWS = st.lists(st.tuples(KEY, KEY, st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 9)), max_size=6)


@SLOW
@given(ROWS, ROWS, ROWS)
def test_stacking_equals_joining(spark, a, b, c):
    frames = {
        "summary": spark.createDataFrame(a, "k int, n int, x int, y int"),
        "keeper": spark.createDataFrame(b, "k int, n int, y int, z int"),
        "misc": spark.createDataFrame(c, "k int, n int, z int, w int"),
    }
    joined = collapse(ops.join_families(frames, ["k", "n"]).drop("n"), ["k"])
    stacked = ops.collapse_families(frames, ["k", "n"], ["k"], drop=["n"])
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, stacked.select(*joined.columns).collect()))


def chained(frames, keys):
    """The plain form: one full join after the other."""
    seen, out = set(keys), None
    for df in frames.values():
        own = df.select(*[c for c in df.columns if c in keys or c not in seen])
        seen.update(df.columns)
        out = own if out is None else out.join(own.distinct(), keys, "full")
    return out


@SLOW
@given(ROWS, ROWS, ROWS)
def test_joining_in_one_shuffle_equals_a_chain_of_full_joins(spark, a, b, c):
    frames = {
        "summary": spark.createDataFrame(a + a[:2], "k int, n int, x int, y int"),
        "keeper": spark.createDataFrame(b + b[:2], "k int, n int, y int, z int"),
        "passing": spark.createDataFrame(b[1:], "k int, n int, y int, x int"),
        "misc": spark.createDataFrame(c + c[:1], "k int, n int, z int, `w 1+2` int"),
    }
    joined, plain = ops.join_families(frames, ["k", "n"]), chained(frames, ["k", "n"])
    assert joined.columns == plain.columns
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))


def test_families_are_shuffled_once(spark):
    frames = {f: spark.range(5).selectExpr("id AS k", f"id AS {f}") for f in ("summary", "keeper", "misc")}
    plan = ops.join_families(frames, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def results(spark):
    base = "https://x/m/"
    rows = [
        ("a/A", "ENG", "1st", 2020, "M", None),
        ("b/B", "ENG", "3rd", 2020, "M", ""),
        ("c/C", "ENG", "1st", 2017, "M", ""),
        ("d/History", "ENG", "1st", 2020, "M", ""),
        ("e/E", "ENG", "1st", 2020, "M", "Match Cancelled"),
        (None, "ENG", "1st", 2020, "M", ""),
        ("g/G", "XXX", "1st", 2020, "M", ""),
        ("h/H", "GER", "1st", 2020, "F", ""),
        ("i/I", "GER", "1st", 2020, "M", ""),
    ]
    full = [(base + r[0] if r[0] else None, *r[1:]) for r in rows]
    return spark.createDataFrame(
        full, "MatchURL string, Country string, Tier string, Season_End_Year bigint, Gender string, Notes string"
    )


def urls(spark, *names):
    return spark.createDataFrame([("https://x/m/" + n,) for n in names], "MatchURL string")


def test_missing_matches(spark):
    seen = urls(spark, "a/A", "b/B", "i/I", "i/I")
    missing = ops.missing_matches(results(spark), seen, seen, urls(spark, "i/I"))
    # B's tier has no advanced statistics; A lacks those due; I has all
    assert [(r.MatchURL, r.filename) for r in missing.collect()] == [
        ("https://x/m/a/A", "stage/html/ENG/A.html")
    ]
    missing = ops.missing_matches(results(spark), urls(spark, "a/A"), seen, urls(spark, "a/A", "i/I"))
    assert sorted(r.MatchURL[-1] for r in missing.collect()) == ["B", "I"]


def test_null_keys_never_match(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "MatchURL string, n int")
    flagged = ops.with_presence_flags(a, seen=a.select("MatchURL"))
    assert {(r.n, r.seen) for r in flagged.collect()} == {(1, False), (2, True)}
    assert ops.orphans(a, a, "MatchURL").count() == 0


def test_key_coverage(spark):
    before = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "a int, b int")
    after = spark.createDataFrame([(1, 1), (4, 4)], "a int, b int")
    assert {tuple(r) for r in key_coverage(before, after, ["a", "b"]).collect()} == {
        (2, 2, "lost"),
        (4, 4, "gained"),
    }


def test_completeness_grid(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "x string, y int")
    grid = {tuple(r) for r in ops.completeness_grid(df, ["x", "y"]).collect()}
    assert grid == {(x, y, (x, y) in {("a", 1), ("b", 2)}) for x in "ab" for y in (1, 2, 3)}
    many = spark.range(20_000).selectExpr("'a' AS x", "id AS y")
    assert ops.completeness_grid(many, ["x", "y"]).filter("present").count() == 20_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_of_a_large_dimension(spark):
    many = spark.range(1_000_000).selectExpr("id AS x", "CASE WHEN id % 2 = 0 THEN 'even' WHEN id < 9 THEN 'odd' END AS y")
    grid = ops.completeness_grid(many, ["x", "y"])
    assert "SinglePartition" not in plan_of(grid) and "collect" not in plan_of(grid) and "Cartesian" not in plan_of(grid)
    assert {(r.y, r.present): r["count"] for r in grid.groupBy("y", "present").count().collect()} == {
        ("even", True): 500_000,
        ("even", False): 500_000,
        ("odd", True): 4,
        ("odd", False): 999_996,
    }
    with pytest.raises(ValueError, match="2000000 cells, more than 1000: x 1000000, y 2"):
        ops.completeness_grid(many, ["x", "y"], most=1000)
    assert ops.completeness_grid(many.where("false"), ["x", "y"]).count() == 0


@pytest.mark.parametrize("blocks", [None, 1, 3, 50])
def test_all_pairs(spark, blocks):
    teams = spark.createDataFrame([(t, t / 10, -t / 10) for t in range(17)] + [(None, 0.0, 0.0)], "team long, attack double, defence double")
    fixtures = spark.createDataFrame([(1, 2, 3), (1, 2, 4), (2, 1, 0), (5, 5, 9), (1, 99, 1), (3, 4, None)], "home long, away long, goals int")
    found = sorted((tuple(r) for r in ops.all_pairs(teams, fixtures, blocks).collect()), key=repr)
    played = {(1, 2): [3, 4], (2, 1): [0]}
    wanted = [(h, a, h / 10, -h / 10, a / 10, -a / 10, g) for h in range(17) for a in range(17) if h != a for g in played.get((h, a), [None])]
    assert found == sorted(wanted, key=repr)


def test_all_pairs_meet_in_blocks(spark):
    teams = spark.range(2000).selectExpr("id AS team", "0.0D AS attack", "0.0D AS defence")
    pairs = ops.all_pairs(teams, spark.createDataFrame([], "home long, away long, goals int"))
    assert "Cartesian" not in plan_of(pairs) and "NestedLoop" not in plan_of(pairs)
    assert pairs.count() == 2000 * 1999
    with pytest.raises(ValueError, match="more than 100"):
        ops.all_pairs(teams, pairs.select("home", "away", "goals"), most=100)
    assert ops.all_pairs(teams.where("false"), pairs.select("home", "away", "goals")).count() == 0


def test_all_pairs_are_not_shuffled(spark):
    teams = spark.range(3000).selectExpr("id AS team", "0.0D AS attack", "0.0D AS defence")
    fixtures = spark.range(9000).selectExpr("id % 3000 AS home", "(id * 7 + 1) % 3000 AS away", "id AS goals")
    pairs = ops.all_pairs(teams, fixtures)
    assert pairs.filter("goals IS NOT NULL").count() == fixtures.filter("home <> away").count()
    # where the pairs are made, no exchange and no sort stands above
    lines = plan_of(pairs).splitlines()
    made = next(i for i, line in enumerate(lines) if "ShuffledHashJoin" in line and "_row" in line)
    assert not any("Exchange" in line or "Sort" in line for line in lines[:made])


def test_attach_league_keeps_unmatched_rows(spark):
    stats = urls(spark, "a/file", "z/file").withColumn("Tier", F.lit("own"))
    matches = results(spark).select("MatchURL", "Country", "Tier", "Gender").filter("MatchURL IS NOT NULL")
    out = {tuple(r) for r in ops.attach_league_by_match_id(stats, matches).collect()}
    assert out == {("own", "https://x/m/a/A", "ENG", "M"), ("own", None, None, None)}


def test_small_aggregates(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "x", None), ("b", "y", 2.0)], "k string, s string, n double")
    shares = {r.k: (r.s, r.n) for r in null_profile(df, ["k"]).collect()}
    assert shares == {"a": (0.5, 0.5), "b": (0.0, 0.0)}
    assert [(r.k, r.Min, r.Max, r.Avg) for r in null_profile_summary(df, ["k"]).collect()] == [
        ("b", 0.0, 0.0, 0.0),
        ("a", 0.5, 0.5, 0.5),
    ]
    assert n_unique(df, "s").first()[0] == 3
    assert n_unique(df, "s", F.col("k") == "none").first()[0] == 0
    assert n_unique(df, "s", approximate=True).first()[0] == 3
    wages = spark.sql("select 'c' Comp, 't' Team, 1 Season, cast(null as double) WeeklyWageGBP")
    assert [tuple(r)[3:] for r in wage_totals(wages).collect()] == [(0.0, None)]


def test_presence_flags_use_all_tasks(spark):
    # partitions of some bytes would be merged to one task, whatever the rows need
    rows = spark.range(0, 1000, 1, 1).selectExpr("concat('https://x/', id) AS MatchURL")
    flagged = ops.with_presence_flags(rows, seen=rows)
    tasks = flagged.groupBy(F.spark_partition_id()).count().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert flagged.filter("seen").count() == 1000
