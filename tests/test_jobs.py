"""Named jobs on small inputs with the declared columns."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators.unions import MatchBundle
from matchloom.plans import extract, ingest, match_pages, seasons
from matchloom.schemas import DEFENSE_ALIASES, LEAGUE_KEYS, MATCH_RESULTS, MATCH_SUMMARY
from matchloom.session import work_folder
from matchloom.sources.pages import parse_tables
from tests.test_pages import PAGES
from tests.test_sources import write

HEAD = "MatchURL,Team,Home_Away,Gender,Country,Tier,Season_End_Year,Match_Date,Home_Formation"


def row(match, team, *stats, country="ENG", formation="4-3-3"):
    return ",".join([match, team, "Home", "M", country, "1st", "1999", "2020-08-01", formation, *stats]) + "\n"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("families"))
    write(root, "summary/ENG_M_1st_a.csv", f"{HEAD},Gls,Ast\n" + row("u1", "A", "2.0", "") + row("u2", "B", "1", ""))
    write(root, "summary/ENG_M_1st_b.csv", f"Unnamed: 0,Gls,{HEAD}\n" + "7,5," + row("u3", "C", country=""))
    write(root, "passing/ENG_M_1st_a.csv", f"{HEAD},Ast,xAG\n" + row("u1", "A", "3", "0.5") + row("u4", "D", "", ""))
    old, new = list(DEFENSE_ALIASES.items())[0]
    write(root, "defense/ENG_M_1st_a.csv", f"{HEAD},{old},Int\n" + row("u1", "A", "4", "1", formation=""))
    write(root, "defense/ENG_M_1st_b.csv", f"{HEAD},{new}\n" + row("u2", "B", "6"))
    return root


def test_wide_team_table(spark, root):
    out = work_folder(spark, "out")
    extract.extract_stats(spark, root, out, "team", ["summary", "passing", "defense"])
    wide = spark.read.parquet(f"{out}/advanced_match_stats_team.parquet")
    found = {r.MatchURL: (r.Country, r.Season_End_Year, r.Gls, r.Ast, r["Def 3rd_Tackles"]) for r in wide.collect()}
    # the summary's empty Ast gives way to passing's; a row without statistics is gone;
    # u1's formation is missing in one family and its rows still meet
    assert found == {
        "u1": ("ENG", 2021, 2, 3, 4),
        "u2": ("ENG", 2021, 1, None, 6),
        "u3": ("ENG", 2021, 5, None, None),
    }
    header = spark.read.parquet(f"{out}/advanced_match_summary.parquet")
    assert header.count() == 4 and "Home_Formation" in header.columns


def test_league_tables_on_disk(spark):
    out = work_folder(spark, "league")
    text = spark.createDataFrame(
        [("C", "M", "USA", "2020", "1st", "18475", "A", "B", "https://x/m/a1/A-Sporting-KC"), (None,) * 9],
        "Competition_Name string, Gender string, Country string, Season_End_Year string, Tier string, Date string,"
        " Home string, Away string, MatchURL string",
    )
    rest = [f.name for f in MATCH_RESULTS if f.name not in text.columns]
    good, bad = ingest.conform_results(text.withColumns({c: F.lit(None).cast("string") for c in rest}))
    assert bad.count() == 1
    known = good.first()
    assert (str(known.Date), known.MatchURL) == ("2020-08-01", "https://x/m/a1/A-Sporting-Kansas-City")
    stats = spark.createDataFrame([("file/a1/x", 3), ("file/zz/x", 4)], "MatchURL string, Gls int")
    ingest.ingest_league_tables(good, out, results=good, team={"summary": stats})
    back = spark.read.parquet(f"{out}/advanced_match_stats/team/summary").collect()
    assert {(r.Gls, r.MatchURL, r.Country, r.Season_End_Year) for r in back} == {
        (3, known.MatchURL, "USA", 2020),
        (4, None, None, None),
    }
    with pytest.raises(ValueError, match="Player"):
        ingest.ingest_league_tables(good, out, team={"summary": stats.withColumn("Player", F.lit("p"))})


def test_page_summary_conforms(spark):
    rows = [("whole", "https://x/m/whole/M", PAGES["whole"])]
    parsed = parse_tables(spark.createDataFrame(rows, "page_id string, url string, html string"))
    raw = spark.createDataFrame(
        [("ENG", "1st", "2021", "M", "Cup")] * 2,
        "country string, tier string, season_end_year string, gender string, competition_name string",
    )
    competitions = ingest.read_competitions(raw)
    good, bad = ingest.conform_summary(match_pages.extract_events(parsed), competitions)
    assert bad.count() == 0 and good.columns == [f.name for f in MATCH_SUMMARY]
    first = good.filter("Event_Type = 'Goal'").first()
    assert (first.Country, first.Competition_Name, first.Season_End_Year, first.Home_Score) == ("ENG", "Cup", 2021, 2)


def test_pages_without_match(spark):
    pages = spark.createDataFrame([("A",), ("Z",)], "name string")
    matches = spark.createDataFrame([("https://x/m/a1/A",)], "MatchURL string")
    assert [r.name for r in ingest.pages_without_match(pages, matches).collect()] == ["Z"]


def test_bundle_of_basic_and_advanced_pages(spark):
    rows = [(n, f"https://x/m/{n}/M", PAGES[n]) for n in ("whole", "one_side", "gone")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    basic, failed = match_pages.parse_pages(pages.filter("page_id <> 'whole'"), ["summary"], shooting=False)
    full, _ = match_pages.parse_pages(pages.filter("page_id = 'whole'"), ["summary", "passing"])
    both = MatchBundle.union(full, basic)
    assert [r.page_id for r in failed.collect()] == ["gone"]
    assert both.shooting.count() == 3 and both.team["summary"].count() == 3 and both.team["passing"].count() == 2


def test_season_files(spark, tmp_path):
    folder, out = str(tmp_path / "seasons"), work_folder(spark, "merged")
    write(folder, "2019_M_misc_player.csv", "Unnamed: 0,Comp,Squad,Player,Fls\n0,La Liga,S,P,1\n1,Cup,S,P,2\n")
    write(folder, "2018_M_misc_player.csv", "Squad,Player,Comp,CrdY\nS,Q,Serie A,4\n")
    write(folder, "2018_M_misc_team.csv", "Squad,Comp\nS,Serie A\n")
    unmapped = seasons.merge_season_files(spark, folder, "misc", "player", out)
    assert [tuple(r) for r in unmapped.collect()] == [("Cup", 1)]
    rows = spark.read.parquet(out).collect()
    assert {(r.Country, r.Season_End_Year, r.Player, r.Fls, r.CrdY, r.Tier) for r in rows} == {
        ("ESP", "2019", "P", "1", None, "1st"),
        ("ITA", "2018", "Q", None, "4", "1st"),
    }
    assert set(LEAGUE_KEYS) < set(spark.read.parquet(out).columns)


def test_historical_results(spark, tmp_path):
    folder = str(tmp_path / "history")
    write(folder, "s_9900_E0.csv", "Home,Empty\nA,\n")
    write(folder, "s_0001_E1.csv", "Home,Away\nB,C\n")
    write(folder, "s_1920_E1.csv", "Home\nD\n")
    df = seasons.historical_results(spark, folder, 1999, 2000)
    assert set(df.columns) == {"Season", "Home", "Away"}
    assert {(r.Season, r.Home, r.Away) for r in df.collect()} == {("9900", "A", None), ("0001", "B", "C")}


def test_competitions_by_name(spark):
    df = spark.createDataFrame([("Première Ligue", "2020-06-30"), ("Cup", "2020-07-01")], "Competition_Name string, Date string")
    rows = {r.Competition_Name: r for r in seasons.conform_competitions(df).collect()}
    assert (rows["Ligue 1"].Country, rows["Ligue 1"].Season_End_Year) == ("FRA", 2019)
    assert (rows["Cup"].Country, rows["Cup"].Season_End_Year) == ("Cup", 2020)


def test_compressed_families(spark, tmp_path):
    import gzip

    folder = tmp_path / "summary"
    folder.mkdir()
    (folder / "ENG_M_1st_a.csv").write_text("MatchURL,Gls\nx,1\n")
    with gzip.open(folder / "ITA_F_2nd_b.csv.gz", "wt") as f:
        f.write("Gls,MatchURL\n2,y\n")
    rows = extract.load_family(spark, str(folder), "summary").select("MatchURL", "Gls", "Country", "Gender", "Tier").collect()
    assert sorted(map(tuple, rows)) == [("x", 1, "ENG", "M", "1st"), ("y", 2, "ITA", "F", "2nd")]
    both = extract.load_family(spark, str(folder / "ITA_F_2nd_b.csv.gz"), "summary")
    assert both.count() == 1


def test_families_share_one_join(spark):
    from checks.joins import short_families

    for df in short_families(spark, "/root/testdata/sf0.001").values():
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_large_tables_are_staged_small(spark):
    from matchloom.session import materialize

    rows = spark.range(10).selectExpr("id", "CAST(id AS string) AS name")
    kept = materialize(rows, "small", "zstd")
    assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
    assert sorted(kept.collect()) == sorted(rows.collect())
