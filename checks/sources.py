"""Round trips: whole tables are written as files, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.analogs import RESULTS
from checks.registry import check, load, run
from matchloom.session import work_folder
from matchloom.sources import files, tables, versions
from matchloom.streaming.increments import ingest_increment, read_increments

KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def write_csv(df, folder, compression="none"):
    df.write.mode("append").options(header=True, escape='"', compression=compression).csv(folder)
    return folder


def drifting_files(spark, d):
    """Line items in folders whose headers differ in order, columns and spelling."""
    items = load(spark, d, "lineitem")
    root = work_folder(spark, "csv")
    note = F.concat(F.lit('say "'), F.col("l_returnflag"), F.lit('", then, '), F.col("l_linestatus"))
    headers = {
        "A": [*KEYS, F.col("l_quantity").alias("Gls")],
        "N": [F.col("l_tax").alias("xG_Expected"), *KEYS[::-1], F.col("l_quantity").cast("int").alias("Gls")],
        "R": ["l_partkey", note.alias("Notes"), "l_orderkey", F.col("l_discount").alias("xG_Expected"), "l_linenumber"],
    }
    for flag, columns in headers.items():
        write_csv(items.filter(F.col("l_returnflag") == flag).select(*columns), f"{root}/{flag}_M_1st_x")
    return root


@check(
    "S1_read_csv_union",
    """SELECT CAST(l_orderkey AS string) AS l_orderkey, CAST(l_partkey AS string) AS l_partkey,
    CAST(l_linenumber AS string) AS l_linenumber,
    CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS string) WHEN 'N' THEN
    CAST(CAST(l_quantity AS bigint) AS string) END AS Gls,
    CASE l_returnflag WHEN 'N' THEN CAST(l_tax AS string) WHEN 'R' THEN CAST(l_discount AS string) END AS xG_Expected,
    CASE l_returnflag WHEN 'R' THEN 'say "R", then, ' || l_linestatus END AS Notes FROM lineitem""",
)
def read_csv_union(spark, d):
    return files.read_csv_union(spark, drifting_files(spark, d)).drop(files.SOURCE)


@check(
    "S1_read_with_catalogue",
    """SELECT CAST(l_orderkey AS string) AS l_orderkey, CAST(l_partkey AS string) AS l_partkey,
    CAST(l_linenumber AS string) AS l_linenumber,
    CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS string) WHEN 'N' THEN
    CAST(CAST(l_quantity AS bigint) AS string) END AS Gls,
    CASE l_returnflag WHEN 'N' THEN CAST(l_tax AS string) WHEN 'R' THEN CAST(l_discount AS string) END AS xG_Expected,
    CASE l_returnflag WHEN 'R' THEN 'say "R", then, ' || l_linestatus END AS Notes FROM lineitem""",
)
def read_with_catalogue(spark, d):
    folder, catalogue = drifting_files(spark, d), work_folder(spark, "catalogue")
    files.catalogued_headers(spark, folder, catalogue).count()
    # the headers are known now: no file is opened for its own
    return files.read_csv_union(spark, folder, catalogue=catalogue).drop(files.SOURCE)


@check(
    "S2_read_typed_csv",
    """SELECT CAST(l_orderkey AS string) AS l_orderkey, CAST(l_partkey AS string) AS l_partkey,
    CAST(CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
    ELSE trunc(l_extendedprice) END AS bigint) AS Gls, CASE WHEN l_returnflag <> 'R' THEN l_tax END AS xG_Expected
    FROM lineitem""",
)
def read_typed_csv(spark, d):
    items = load(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("string")
    dirty = F.when(F.col("l_returnflag") == "A", "n/a").when(
        (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "NaN"
    )
    rows = items.select(
        "l_orderkey",
        "l_partkey",
        F.coalesce(dirty, price).alias("Gls"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("xG_Expected"),
    )
    folder = write_csv(rows, work_folder(spark, "typed"))
    return files.read_typed_csv(spark, folder, "summary").drop(files.SOURCE)


@check(
    "S3_with_file_keys",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'own' ELSE l_returnflag END
    AS Country, l_linestatus AS Gender, '1st' AS Tier, CAST(NULL AS string) AS stat FROM lineitem""",
)
def with_file_keys(spark, d):
    items = load(spark, d, "lineitem")
    own = F.when(F.col("l_linestatus") == "O", "own").alias("Country")
    name = F.concat_ws("_", "l_returnflag", "l_linestatus", F.lit("1st"), F.lit("x")).alias("f")
    folder = work_folder(spark, "keys")
    items.select(*KEYS, own, name).write.partitionBy("f").option("header", True).csv(folder)
    read = files.read_csv_union(spark, folder)
    keyed = files.with_file_keys(read, "f={Country}_{Gender}_{Tier}_x/*.csv")
    keyed = files.with_file_keys(keyed, "other/{stat}.csv")
    return keyed.drop(files.SOURCE).withColumns({k: F.col(k).cast("bigint") for k in KEYS})


@check(
    "S4_json_documents",
    """SELECT 'lineup' AS kind, l_orderkey AS match_id, unnest(['home', 'home', 'away']) AS side,
    CAST(unnest([0, 1, 0]) AS bigint) AS position,
    unnest([l_partkey, l_suppkey, CAST(l_linenumber AS bigint)]) AS player_id, l_returnflag AS name FROM lineitem
    WHERE l_linestatus = 'O'
    UNION ALL SELECT 'match', o_orderkey, NULL, NULL, o_custkey, o_orderpriority FROM orders
    UNION ALL SELECT 'bad', l_orderkey, NULL, NULL, NULL, NULL FROM lineitem WHERE l_linestatus = 'F'""",
)
def json_documents(spark, d):
    """Documents stored in a table, one per line item; those of one status are cut off and so unreadable."""
    items, orders = load(spark, d, "lineitem"), load(spark, d, "orders")

    def team(number, *players):
        lineup = F.array(
            *[
                F.struct(F.col(p).cast("bigint").alias("player_id"), F.col("l_returnflag").alias("player_name"))
                for p in players
            ]
        )
        return F.struct(F.lit(number).alias("team_id"), F.lit(f"t{number}").alias("team_name"), lineup.alias("lineup"))

    text = F.to_json(F.array(team(1, "l_partkey", "l_suppkey"), team(2, "l_linenumber")))
    cut = F.when(F.col("l_linestatus") == "F", F.substring(text, 2, 9)).otherwise(text)
    stored = items.select(F.col("l_orderkey").alias("match_id"), cut.alias("value"))
    match = F.struct(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_custkey").alias("home_score"),
        F.struct(F.lit(1).alias("season_id"), F.col("o_orderpriority").alias("season_name")).alias("season"),
    )
    players, bad = files.lineup_documents(stored)
    found, _ = files.match_documents(orders.select(F.to_json(F.array(match)).alias("value")))
    a = players.select(
        F.lit("lineup").alias("kind"),
        "match_id",
        "side",
        F.col("position").cast("bigint").alias("position"),
        "player_id",
        F.col("player_name").alias("name"),
    )
    none, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    b = found.select(F.lit("match"), "match_id", none, number, "home_score", "season.season_name")
    return a.unionAll(b).unionAll(bad.select(F.lit("bad"), "match_id", none, number, number, none))


@check("S5_read_extract", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def read_extract(spark, d):
    names = tables.extract_schema(spark, d, "customer").fieldNames()
    return tables.read_extract(spark, d, "customer").select(*[n for n in names if n in ("c_custkey", "c_name", "c_mktsegment")])


@check(
    "S6_write_partitioned",
    "SELECT MatchKey, Date, Notes, Country, Gender, Tier FROM (SELECT MatchKey, CAST(Date AS string) AS Date, Notes,"
    " Country, Gender, Tier FROM results)",
    results=RESULTS,
)
def write_partitioned(spark, d):
    path = work_folder(spark, "partitioned")
    keys = ["Gender", "Tier"]
    results = run(spark, d, RESULTS).select(
        "MatchKey", F.col("Date").cast("string").alias("Date"), "Notes", "Country", *keys
    )
    tables.write_partitioned(results, path, keys)
    # writing some leagues again replaces those and leaves the rest
    tables.write_partitioned(results.filter("Tier = '1'"), path, keys)
    back = spark.read.parquet(path)
    return back.withColumn("Tier", F.col("Tier").cast("string"))


@check(
    "S7_write_sorted",
    "SELECT l_orderkey, l_suppkey, l_returnflag, l_quantity FROM lineitem",
)
def write_sorted(spark, d):
    path = work_folder(spark, "sorted")
    items = load(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_quantity")
    tables.write_sorted(items, path, ["l_returnflag", "l_suppkey"])
    return spark.read.parquet(path)


@check(
    "S8_register_extracts",
    "SELECT r_name, n_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def register_extracts(spark, d):
    tables.register_extracts(spark, d, prefix="extract_")
    return spark.sql(
        """SELECT r_name, n_name, n_nationkey FROM extract_nation JOIN extract_region ON n_regionkey = r_regionkey"""
    )


UPSERT = """SELECT CASE WHEN Country = 'NATION_3' THEN Country ELSE 'OTHER' END AS Country, CASE WHEN Tier = '1' AND Country = 'NATION_3' THEN 'NA_character_' ELSE Notes END AS Notes,
    MatchKey, MatchURL AS Game_URL, 'file' AS MatchURL, Date AS Match_Date, CAST(0 AS bigint) AS Season_End_Year,
    Gender, Tier FROM {results}"""


@check(
    "S9_upsert",
    """SELECT MatchKey, Country, Gender, Tier, Notes, MatchURL, Season_End_Year, CAST(NULL AS bigint) AS extra FROM
    (SELECT MatchKey, Country, Gender, Tier, Notes, MatchURL, 0 AS Season_End_Year FROM stored
        WHERE NOT (Country = 'NATION_3' AND Gender = 'F' AND Tier = '1')
     UNION ALL SELECT DISTINCT MatchKey, 'NATION_3', 'F', '1', CASE WHEN Notes = 'NA_character_' THEN '' ELSE Notes
        END, Game_URL, CASE WHEN month(Match_Date) <= 6 THEN year(Match_Date) ELSE year(Match_Date) + 1 END FROM stored
        WHERE Country = 'NATION_3' AND Tier = '1' AND Gender IN ('F', 'O'))""",
    results=RESULTS,
    stored=UPSERT,
)
def upsert(spark, d):
    path = work_folder(spark, "upsert")
    rows = run(spark, d, UPSERT, results=run(spark, d, RESULTS))
    tables.write_partitioned(rows, path, ["Country", "Gender", "Tier"])
    league = rows.filter("Country = 'NATION_3' AND Tier = '1'")
    # rows stored before and new ones, with a column the table does not have
    new = league.filter("Gender IN ('F', 'O')").withColumn("extra", F.lit(None).cast("bigint"))
    tables.upsert(spark, path, new, "NATION_3", "F", "1")
    back = spark.read.option("mergeSchema", "true").parquet(path)
    return back.select(
        "MatchKey",
        "Country",
        "Gender",
        F.col("Tier").cast("string").alias("Tier"),
        "Notes",
        "MatchURL",
        "Season_End_Year",
        "extra",
    )


@check(
    "S9_upsert_version",
    """SELECT 3 AS version, MatchKey, Country, Gender, Tier, Notes, MatchURL, Season_End_Year FROM
    (SELECT DISTINCT MatchKey, 'NATION_3' AS Country, 'F' AS Gender, '1' AS Tier,
        CASE WHEN Notes = 'NA_character_' THEN '' ELSE Notes END AS Notes, Game_URL AS MatchURL,
        CASE WHEN month(Match_Date) <= 6 THEN year(Match_Date) ELSE year(Match_Date) + 1 END AS Season_End_Year
        FROM stored WHERE Country = 'NATION_3' UNION ALL
     SELECT DISTINCT MatchKey, 'OTHER', 'M', '2', CASE WHEN Notes = 'NA_character_' THEN '' ELSE Notes END, Game_URL,
        CASE WHEN month(Match_Date) <= 6 THEN year(Match_Date) ELSE year(Match_Date) + 1 END FROM stored
        WHERE Country = 'OTHER') UNION ALL
    SELECT 2, MatchKey, 'NATION_3', 'F', '1', CASE WHEN Notes = 'NA_character_' THEN '' ELSE Notes END, Game_URL,
    CASE WHEN month(Match_Date) <= 6 THEN year(Match_Date) ELSE year(Match_Date) + 1 END FROM stored
    WHERE Country = 'NATION_3' AND Tier = '1' UNION ALL
    SELECT 2, MatchKey, 'OTHER', 'M', '2', CASE WHEN Notes = 'NA_character_' THEN '' ELSE Notes END, Game_URL,
    CASE WHEN month(Match_Date) <= 6 THEN year(Match_Date) ELSE year(Match_Date) + 1 END FROM stored
    WHERE Country = 'OTHER'""",
    results=RESULTS,
    stored=UPSERT,
)
def upsert_version(spark, d):
    path = work_folder(spark, "versions")
    rows = run(spark, d, UPSERT, results=run(spark, d, RESULTS))
    own = rows.filter("Country = 'NATION_3'")
    versions.upsert_version(spark, path, own.filter("Tier = '1'"), "NATION_3", "F", "1")
    versions.upsert_version(spark, path, rows.filter("Country = 'OTHER'"), "OTHER", "M", "2")
    before = versions.read_version(spark, path)  # stays as it is, whatever is published later
    versions.upsert_version(spark, path, own, "NATION_3", "F", "1")
    names = ["MatchKey", "Country", "Gender", "Tier", "Notes", "MatchURL", "Season_End_Year"]
    now = versions.read_version(spark, path).select(F.lit(3).alias("version"), *names)
    return now.unionAll(before.select(F.lit(2), *names))


@check(
    "S10_read_cached_slice",
    """SELECT 'season' AS by, MatchKey FROM results WHERE Season_End_Year = 1999 UNION ALL
    SELECT 'url', MatchKey FROM results WHERE year(Date) = 1998""",
    results=RESULTS,
)
def read_cached_slice(spark, d):
    results = run(spark, d, RESULTS)
    by_season = tables.read_cached_slice(results, 1999)
    years = F.concat_ws("-", (F.year("Date")).cast("string"), (F.year("Date") + 1).cast("string"))
    urls = results.select("MatchKey", F.concat(F.lit("https://x.test/"), years, F.lit("/stats")).alias("url"))
    by_url = tables.read_cached_slice(urls, 1999)
    assert tables.read_cached_slice(results, 2050) is None
    season = by_season.select(F.lit("season").alias("by"), "MatchKey")
    return season.unionAll(by_url.select(F.lit("url"), "MatchKey"))


@check(
    "S11_ingest_increment",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS batch,
    CASE WHEN l_returnflag = 'R' THEN l_tax END AS tax FROM lineitem""",
)
def increment(spark, d):
    stage, base, state = (work_folder(spark, n) for n in ("stage", "base", "state"))
    items = load(spark, d, "lineitem")
    write_csv(items.filter("l_returnflag <> 'R'").select(*KEYS), f"{stage}/first")
    ingest_increment(spark, stage, base, state)
    late = items.filter("l_returnflag = 'R'").select(F.col("l_tax").alias("tax"), *KEYS)
    write_csv(late, f"{stage}/second")
    ingest_increment(spark, stage, base, state)
    ingest_increment(spark, stage, base, state)
    rows = read_increments(spark, base)
    return rows.select(
        *[F.col(k).cast("bigint").alias(k) for k in KEYS],
        F.col("batch").cast("bigint").alias("batch"),
        F.col("tax").cast("double").alias("tax"),
    )


@check(
    "S12_schema_inventory",
    """SELECT stat, position, name, name NOT IN ('Gls', 'xG_Expected', 'l_orderkey', 'l_partkey', 'l_linenumber')
    AS deviates FROM (
    SELECT DISTINCT 'A_M_1st_x' AS stat, unnest(range(4)) AS position,
        unnest(['l_orderkey', 'l_partkey', 'l_linenumber', 'Gls']) AS name FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT DISTINCT 'N_M_1st_x', unnest(range(5)),
        unnest(['xG_Expected', 'l_linenumber', 'l_partkey', 'l_orderkey', 'Gls']) FROM lineitem
        WHERE l_returnflag = 'N'
    UNION ALL SELECT DISTINCT 'R_M_1st_x', unnest(range(5)),
        unnest(['l_partkey', 'Notes', 'l_orderkey', 'xG_Expected', 'l_linenumber']) FROM lineitem
        WHERE l_returnflag = 'R')""",
)
def schema_inventory(spark, d):
    inventory = files.schema_inventory(spark, drifting_files(spark, d), "{stat}/*.csv")
    family = inventory.withColumn("family", F.lit("summary"))
    odd = files.schema_deviations(family, KEYS, "family").select("path", "position", F.lit(True).alias("deviates"))
    marked = family.join(odd, ["path", "position"], "left")
    return marked.select(
        "stat",
        F.col("position").cast("bigint").alias("position"),
        F.col("column").alias("name"),
        F.coalesce("deviates", F.lit(False)).alias("deviates"),
    ).distinct()


@check(
    "S13_stale_slices",
    """SELECT DISTINCT Country, Tier, Season_End_Year FROM results r WHERE Season_End_Year >= 2001 OR NOT EXISTS
    (SELECT 1 FROM results e WHERE e.Country = r.Country AND e.Tier = r.Tier
        AND e.Season_End_Year = r.Season_End_Year AND e.MatchURL LIKE '%Play-offs%')""",
    results=RESULTS,
)
def stale_slices(spark, d):
    results = run(spark, d, RESULTS)
    stored = results.filter(F.col("MatchURL").contains("Play-offs"))
    return tables.stale_slices(results, stored, ["Country", "Tier", "Season_End_Year"], 2001, update=True)


