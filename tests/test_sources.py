"""Files with drifting headers, stored tables and increments."""

import json
import os
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from matchloom.session import work_folder
from matchloom.sources import files, tables, versions
from matchloom.streaming import increments, profiles
from matchloom.streaming.increments import ingest_increment, read_increments


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def folder(tmp_path):
    root = str(tmp_path / "stage")
    write(root, "summary/ENG_M_1st_wf.csv", 'Player,Gls,xG_Expected\n"Lee, A",3.0,0.5\nNA_character_,NaN,\n')
    write(root, "summary/GER_M_2nd_wf_0001.csv", ",Gls,Player\n0,x,Bo\n1,,\n")
    write(root, "summary/results.csv", "Player\nCy\n")
    write(root, "summary/empty.csv", "")
    return root


def test_columns_go_by_name(spark, folder):
    df = files.read_csv_union(spark, folder)
    assert sorted(c for c in df.columns if c != files.SOURCE) == ["Gls", "Player", "Unnamed: 0", "xG_Expected"]
    rows = {(r.Player, r.Gls, r["Unnamed: 0"], r.xG_Expected) for r in df.collect()}
    assert rows == {
        ("Lee, A", "3.0", None, "0.5"),
        ("NA_character_", "NaN", None, None),
        ("Bo", "x", "0", None),
        (None, None, "1", None),
        ("Cy", None, None, None),
    }


def test_known_files_are_not_opened_again(spark, folder, tmp_path, monkeypatch):
    log, catalogue, first_line = str(tmp_path / "opened"), str(tmp_path / "catalogue"), files._first_line

    def logged(path):
        with open(log, "a") as f:
            f.write(path.rsplit("/", 1)[1] + "\n")
        return first_line(path)

    def opened():
        with open(log, "a+") as f:
            f.seek(0)
            names = sorted(f.read().split())
            f.truncate(0)
        return names

    monkeypatch.setattr(files, "_first_line", logged)
    plain = sorted(map(str, files.read_csv_union(spark, folder).collect()))
    every = opened()
    read = lambda: sorted(map(str, files.read_csv_union(spark, folder, catalogue=catalogue).collect()))
    assert read() == plain and opened() == every
    assert read() == plain and opened() == []
    write(folder, "summary/late.csv", "Player,Extra\nDi,1\n")
    assert len(read()) == len(plain) + 1 and opened() == ["late.csv"]
    write(folder, "summary/late.csv", "Player,Other,Extra\nDi,2,1\nEd,3,4\n")
    assert len(read()) == len(plain) + 2 and opened() == ["late.csv"]
    os.remove(os.path.join(folder, "summary/late.csv"))
    assert read() == plain and opened() == []


def test_typed_columns(spark, folder):
    df = files.read_typed_csv(spark, folder, "summary")
    assert dict(df.dtypes)["Gls"] == "bigint" and dict(df.dtypes)["xG_Expected"] == "double"
    assert {(r.Player, r.Gls) for r in df.collect() if r.Gls is not None} == {("Lee, A", 3)}


def test_file_keys(spark, folder):
    keyed = files.with_file_keys(files.read_csv_union(spark, folder), "{Country}_{Gender}_{Tier}_*.csv")
    found = {(r.Player, r.Country, r.Gender, r.Tier) for r in keyed.collect() if r.Player}
    assert found == {
        ("Lee, A", "ENG", "M", "1st"),
        ("NA_character_", "ENG", "M", "1st"),
        ("Bo", "GER", "M", "2nd"),
        ("Cy", None, None, None),
    }
    own = keyed.withColumn("Tier", F.when(F.col("Country") == "ENG", "own"))
    again = files.with_file_keys(own, "{Tier}_*_*_*.csv").filter("Player = 'Lee, A' OR Player = 'Bo'")
    assert {(r.Player, r.Tier) for r in again.collect()} == {("Lee, A", "own"), ("Bo", "GER")}


def test_folder_fields_may_hold_underscores(spark):
    df = spark.createDataFrame([("/x/ENG/1st/2020/match_stats/passing_types.csv",)], ["source_file"])
    keyed = files.with_file_keys(df, "{country}/{tier}/{year}/match_stats/{stat}.csv").first()
    assert (keyed.country, keyed.tier, keyed.year, keyed.stat) == ("ENG", "1st", "2020", "passing_types")


def test_names_with_spaces_and_signs(spark, tmp_path):
    write(str(tmp_path), "Côte d+1_M_1st_x.csv", "a\n1\n")
    keyed = files.with_file_keys(files.read_csv_union(spark, str(tmp_path)), "{Country}_{Gender}_{Tier}_x.csv")
    assert [(r.a, r.Country) for r in keyed.collect()] == [("1", "Côte d+1")]


def test_inventory(spark, folder):
    inventory = files.schema_inventory(spark, folder, "{stat}/*.csv")
    assert inventory.count() == 7
    odd = files.schema_deviations(inventory, ["Player"]).collect()
    assert [(r.stat, r.column) for r in odd] == [("summary", "Unnamed: 0")]


def test_duplicate_columns_are_an_error():
    with pytest.raises(ValueError, match="duplicate"):
        files.header_columns("a,b,a")


def test_json_files(spark, tmp_path):
    root = str(tmp_path / "json")
    team = {"team_id": 1, "team_name": "t", "lineup": [{"player_id": 7, "player_name": "p"}]}
    write(root, "lineups/12.json", json.dumps([team, {**team, "team_id": 2, "lineup": []}]))
    write(root, "lineups/13.json", json.dumps([team]))
    write(root, "lineups/14.json", "[{")
    write(root, "lineups/name.json", json.dumps([team, team]))
    players, bad = files.read_lineup_json(spark, f"{root}/lineups")
    assert [tuple(r) for r in players.collect()] == [(12, "home", 1, "t", 0, 7, "p")]
    assert sorted(os.path.basename(r.source_file) for r in bad.collect()) == ["13.json", "14.json", "name.json"]
    match = {"match_id": 1, "home_score": 2, "away_score": 0, "season": {"season_id": 3, "season_name": "s"}}
    write(root, "matches/2/3.json", json.dumps([match, {"home_score": 1}], indent=2))
    write(root, "matches/2/4.json", "oops")
    found, bad = files.read_match_json(spark, f"{root}/matches")
    assert [(r.match_id, r.home_score, r.season.season_name) for r in found.collect()] == [(1, 2, "s")]
    assert bad.count() == 1


def test_increments_append_once(spark, folder, tmp_path):
    base, state = str(tmp_path / "base"), str(tmp_path / "state")
    ingest_increment(spark, folder, base, state)
    write(folder, "summary/late.csv", "Player,Extra\nDi,1\n")
    for _ in range(2):
        ingest_increment(spark, folder, base, state)
    rows = read_increments(spark, base)
    assert {(r.batch, r["count"]) for r in rows.groupBy("batch").count().collect()} == {(1, 5), (2, 1)}
    assert [r.Extra for r in rows.filter("batch = 2").collect()] == ["1"]


def test_many_small_files_come_in_several_batches(spark, tmp_path, monkeypatch):
    stage, base, state = (str(tmp_path / n) for n in ("stage", "base", "state"))
    os.makedirs(stage)
    for i in range(10_000):
        with open(f"{stage}/f{i:05d}.csv", "w") as f:
            f.write(f"id,{'odd' if i % 2 else 'even'}\n{i},x\n")
    seen, whole = [], increments.read_csv_union

    def breaks_once(session, paths, glob):
        seen.append(len(paths))
        if len(seen) == 3:
            raise OSError("the second batch breaks off after its first slice")
        return whole(session, paths, glob)

    monkeypatch.setattr(increments, "read_csv_union", breaks_once)
    # files of 11 or 12 bytes: about 3,000 in a slice
    with pytest.raises(Exception, match="breaks off"):
        ingest_increment(spark, stage, base, state, max_bytes=40_000)
    ingest_increment(spark, stage, base, state, max_bytes=40_000)
    rows = read_increments(spark, base)
    assert max(seen) <= 4000 and len(seen) >= 6
    assert {r.batch: r["count"] for r in rows.groupBy("batch").count().collect()} == {1: 4000, 2: 4000, 3: 2000}
    assert rows.select("id").distinct().count() == rows.count() == 10_000


def test_paths_that_do_not_fit_are_counted(spark):
    paths = ["a/ENG_M_1st_x.csv", "a/ENG_M_1st_x.csv", "a/ENG-M.csv", "a/ENG-M.csv", "b/other.csv", None]
    df, seen = spark.createDataFrame([(p,) for p in paths], "source_file string"), Observation()
    rows = files.with_file_keys(df, "{Country}_{Gender}_{Tier}_*.csv", observation=seen).collect()
    assert [r.Country for r in rows].count("ENG") == 2 and seen.get == {"unfit_rows": 4, "unfit_paths": 3}


def test_profile_reads_new_batches_only(spark, tmp_path):
    base, state = str(tmp_path / "base"), str(tmp_path / "state")
    assert profiles.update_profile(spark, base, state, ["k"], "id") == []
    parts = [spark.range(a, b).selectExpr("id % 2 AS k", "id", "CASE WHEN id % 3 = 0 THEN id END AS v") for a, b in ((0, 4000), (2000, 6000), (0, 10))]
    for n, df in enumerate(parts, 1):
        (df.withColumn("w", F.lit(1)) if n == 3 else df).write.parquet(f"{base}/batch={n:04d}")
        assert profiles.update_profile(spark, base, state, ["k"], "id") == [n]
        # what is counted is not read again
        (tmp_path / "base" / f"batch={n:04d}").rename(tmp_path / f"away{n}")
        (tmp_path / "base" / f"batch={n:04d}").mkdir()
    assert profiles.update_profile(spark, base, state, ["k"], "id") == []
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    wanted = {r.k: (r.n, r.v) for r in whole.groupBy("k").agg(F.count("*").alias("n"), F.avg(F.col("v").isNull().cast("int")).alias("v")).collect()}
    for r in profiles.read_profile(spark, state, ["k"]).collect():
        assert (r.rows, r.v) == (wanted[r.k][0], pytest.approx(wanted[r.k][1])) and r.w == pytest.approx(1 - 5 / r.rows)
        assert r.distinct_values == pytest.approx(3000, rel=0.1) and r.id == 0


def test_late_files_are_appended(spark, folder, tmp_path):
    base, state = str(tmp_path / "base"), str(tmp_path / "state")
    ingest_increment(spark, folder, base, state)
    write(folder, "summary/old.csv", "Player,Extra\nDi,1\n")
    old = time.time() - 400 * 86_400
    os.utime(os.path.join(folder, "summary/old.csv"), (old, old))
    ingest_increment(spark, folder, base, state)
    assert read_increments(spark, base).filter("Extra = '1'").count() == 1


def test_upsert_keeps_columns_keys_and_other_leagues(spark):
    path = work_folder(spark, "upsert")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, Country string, Gender string, Tier string")
    tables.upsert(spark, path, rows((1, "ENG", "M", "0102")).withColumn("extra", F.lit(99)), "ENG", "M", "0102")
    tables.upsert(spark, path, rows((3, "GER", "M", "0102")), "GER", "M", "0102")
    refused = tables.upsert(spark, path, rows((2, None, "M", "0102"), (4, "GER", "M", "0102")), "ENG", "M", "0102")
    assert [r.id for r in refused.collect()] == [4]
    back = tables.read_partitioned(spark, path)
    found = sorted((r.id, r.extra, r.Country, r.Tier) for r in back.collect())
    assert found == [(1, 99, "ENG", "0102"), (2, None, "ENG", "0102"), (3, None, "GER", "0102")]
    assert tables.read_partitioned(spark, path + "-none") is None


def test_sorted_files_are_in_order_though_one_value_is_hot(spark):
    path = work_folder(spark, "sorted")
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 10).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_sorted(df, path, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    spans = (
        back.groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n"))
        .orderBy("f")
        .collect()
    )
    assert back.count() == 20_000 and len(spans) > 3
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))
    assert max(s.n for s in spans) < 10_000  # the hot value is spread over files


def test_partitioned_write_replaces_only_its_keys(spark):
    path = work_folder(spark, "parts")
    df = spark.range(100).withColumn("g", F.col("id") % 4)
    tables.write_partitioned(df, path, ["g"])
    tables.write_partitioned(df.filter("g = 1").limit(5), path, ["g"])
    sizes = {r.g: r["count"] for r in spark.read.parquet(path).groupBy("g").count().collect()}
    assert sizes == {0: 25, 1: 5, 2: 25, 3: 25}


def stored(spark):
    return spark.sql(
        """SELECT * FROM VALUES ('ENG', 'M', '1st', date'2020-06-30', 'u1', 'NA_character_', 'Cup', 1),
        ('ENG', 'M', '1st', date'2020-07-01', 'u2', 'x', null, 2), ('GER', 'M', '1st', date'2020-01-01', 'u3', 'y', 'C', 3)
        AS t(Country, Gender, Tier, Match_Date, Game_URL, Notes, Competition_Name, pos)"""
    )


def test_upsert_rewrites_one_league(spark):
    path = work_folder(spark, "upsert")
    tables.write_partitioned(stored(spark), path, ["Country", "Gender", "Tier"])
    new = stored(spark).filter("pos = 2").drop("Country").withColumns(
        {"pos": F.lit(2.5), "Match_Date": F.lit("2021-08-01"), "Extra": F.lit("e")}
    )
    tables.upsert(spark, path, new, "ENG", "M", "1st", ["pos"])
    rows = spark.read.option("mergeSchema", "true").parquet(f"{path}/Country=ENG")
    found = sorted((r.Game_URL, r.Notes, r.Competition_Name, r.Season_End_Year, r.Extra) for r in rows.filter("Extra IS NULL").collect())
    assert found == [("u1", "", "Cup", 2020, None), ("u2", "x", "Cup", 2021, None)]
    late = rows.filter("Extra = 'e'").first()
    assert (late.Competition_Name, late.Season_End_Year, late.Extra, str(late.Match_Date)) == ("Cup", 2022, "e", "2021-08-01")
    assert spark.read.parquet(f"{path}/Country=GER").count() == 1


def league(spark, country, *ids):
    return spark.createDataFrame([(i, country, "M", "1st") for i in ids], "id int, Country string, Gender string, Tier string")


def ids_of(df):
    return sorted(r.id for r in df.collect()) if df is not None else None


def test_versions_are_published_whole(spark, monkeypatch):
    path = work_folder(spark, "versions")
    assert versions.read_version(spark, path) is None and versions.newest_version(spark, path) == 0
    versions.upsert_version(spark, path, league(spark, "ENG", 1, 2), "ENG", "M", "1st")
    versions.upsert_version(spark, path, league(spark, "GER", 3).withColumn("extra", F.lit("e")), "GER", "M", "1st")
    open_frame = versions.read_version(spark, path)

    def killed(*_):
        raise KeyboardInterrupt

    publish = versions._publish
    monkeypatch.setattr(versions, "_publish", killed)
    with pytest.raises(KeyboardInterrupt):
        versions.upsert_version(spark, path, league(spark, "ENG", 4), "ENG", "M", "1st")
    monkeypatch.setattr(versions, "_publish", publish)
    assert versions.newest_version(spark, path) == 2 and ids_of(versions.read_version(spark, path)) == [1, 2, 3]
    # the run is repeated; what was read before stays
    refused = versions.upsert_version(spark, path, league(spark, "ENG", 4).unionAll(league(spark, "GER", 9)), "ENG", "M", "1st")
    assert ids_of(refused) == [9]
    assert ids_of(versions.read_version(spark, path)) == [1, 2, 3, 4] and ids_of(open_frame) == [1, 2, 3]
    assert ids_of(versions.read_version(spark, path, [("GER", "M", "1st")])) == [3]
    assert ids_of(versions.read_version(spark, path, version=1)) == [1, 2]
    assert versions.read_version(spark, path, [("ITA", "M", "1st")]) is None
    with pytest.raises(ValueError, match="no version 9"):
        versions.read_version(spark, path, version=9)
    # the folder of the killed run and that of the first version of the league
    assert versions.remove_unnamed(spark, path, keep=1, hours=24) == 0
    assert versions.remove_unnamed(spark, path, keep=1, hours=-1) == 2
    assert ids_of(versions.read_version(spark, path)) == [1, 2, 3, 4]


def test_versions_of_two_writers(spark):
    path = work_folder(spark, "versions")
    first, second = ("ENG", "M", "1st"), ("GER", "M", "1st")
    assert versions.replace_parts(spark, path, {first: league(spark, "ENG", 1)}, 0) == 1
    # made from version 0 too, but of another league: both count
    assert versions.replace_parts(spark, path, {second: league(spark, "GER", 2)}, 0) == 2
    with pytest.raises(versions.VersionConflict, match="ENG"):
        versions.replace_parts(spark, path, {first: league(spark, "ENG", 3)}, 0)
    assert ids_of(versions.read_version(spark, path)) == [1, 2]
    assert not versions._publish(spark, path, 2, {}) and ids_of(versions.read_version(spark, path)) == [1, 2]


def test_cached_slices(spark):
    df = spark.createDataFrame([(2020, "https://x/2019-2020/s")], "Season_End_Year int, url string")
    assert tables.read_cached_slice(df, 2020).count() == 1
    assert tables.read_cached_slice(df, 2021) is None
    assert tables.read_cached_slice(df.select("url"), 2020).count() == 1
    with pytest.raises(ValueError, match="neither"):
        tables.read_cached_slice(spark.range(1), 2020)


def test_new_rows_are_mapped_before_they_are_stored(spark):
    new = spark.createDataFrame([("f1", 18475.0), ("f2", None)], "MatchURL string, Date double")
    mapping = spark.createDataFrame([("f1", "u1")], "MatchURL string, Game_URL string")
    out = {(r.MatchURL, str(r.Date)) for r in tables.prepare_new(new, mapping).collect()}
    assert out == {("u1", "2020-08-01"), ("f2", "None")}


def test_stale_slices(spark):
    slices = spark.createDataFrame([("ENG", 2020), ("ENG", 2021), ("GER", 2021)], "Country string, Season_End_Year int")
    have = slices.filter("Country = 'ENG'")
    keys = ["Country", "Season_End_Year"]
    stale = {tuple(r) for r in tables.stale_slices(slices, have, keys, 2021, update=True).collect()}
    assert stale == {("ENG", 2021), ("GER", 2021)}
    stale = {tuple(r) for r in tables.stale_slices(slices, have, keys, 2021, update=False).collect()}
    assert stale == {("GER", 2021)}


class Cluster:
    """A session as far as the work folder looks at it."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})


def test_work_folder_is_below_the_named_one(spark):
    named = Cluster("yarn", **{"spark.checkpoint.dir": "hdfs://shared/work/"})
    assert work_folder(named, "x").startswith("hdfs://shared/work/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Cluster("yarn"), "x")
    assert "matchloom-" in work_folder(Cluster("local[2]"), "x")


def test_documents_are_parsed_once(spark):
    stored = spark.createDataFrame([(1, "[]")], "match_id bigint, value string")
    for found in (files.lineup_documents(stored), files.match_documents(stored.select("value"))):
        for df in found:
            assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
