"""Season files: merging by statistic, historical results, competition names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import map_value, parse_date, season_label, season_start_year
from matchloom.operators.cleaning import drop_all_null_columns, drop_junk_columns, stamp
from matchloom.schemas import LEAGUE_KEYS
from matchloom.sources.files import SOURCE, read_csv_union, with_file_keys

# The country of each big league.
COMP_COUNTRY = {
    "Bundesliga": "GER",
    "La Liga": "ESP",
    "Ligue 1": "FRA",
    "Premier League": "ENG",
    "Serie A": "ITA",
}
# Competition names to rename, and (country, gender, tier) by name.
COMPETITION_NAMES = {
    "A-Junioren Bundesliga": "U19 DFB Youth League",
    "B-Junioren Bundesliga": "U17 DFB Youth League",
    "Première Ligue": "Ligue 1",
    "Budesliga": "Bundesliga",
}
COMPETITIONS = {
    "Premier League": ("ENG", "M", "1st"),
    "EFL Championship": ("ENG", "M", "2nd"),
    "EFL League One": ("ENG", "M", "3rd"),
    "EFL League Two": ("ENG", "M", "4th"),
    "National League": ("ENG", "M", "5th"),
    "La Liga": ("ESP", "M", "1st"),
    "Spanish Segunda División": ("ESP", "M", "2nd"),
    "Fußball-Bundesliga": ("GER", "M", "1st"),
    "2. Fußball-Bundesliga": ("GER", "M", "2nd"),
    "3. Fußball-Liga": ("GER", "M", "3rd"),
    "Serie A": ("ITA", "M", "1st"),
    "Serie B": ("ITA", "M", "2nd"),
    "Ligue 1": ("FRA", "M", "1st"),
    "Ligue 2": ("FRA", "M", "2nd"),
    "Frauen-Bundesliga": ("GER", "F", "1st"),
    "Championnat de France de Football Féminin": ("FRA", "F", "1st"),
    "FA Women's Super League": ("ENG", "F", "1st"),
    "Liga F": ("ESP", "F", "1st"),
    "Premier League 2": ("ENG", "M", "1st"),
    "Premier League 2 — Division 2": ("ENG", "M", "2nd"),
    "A-Junioren Bundesliga": ("GER", "M", "1st"),
    "U19 DFB Youth League": ("GER", "M", "1st"),
    "B-Junioren Bundesliga": ("GER", "M", "1st"),
    "U17 DFB Youth League": ("GER", "M", "1st"),
    "Première Ligue": ("FRA", "M", "1st"),
}


def merge_season_files(
    spark: SparkSession,
    folder: str,
    stat: str,
    level: str,
    out: str,
    countries: dict[str, str] | None = None,
    gender: str = "M",
    tier: str = "1st",
    glob: str | None = None,
    pattern: str = "{Season_End_Year}_*.csv",
) -> DataFrame:
    """All ``{year}_*_{stat}_{level}.csv`` as one table, partitioned by league and sorted.

    Rows are sorted by season and squad (and player) within each file. Rows of competitions without a country
    are not stored; returns how many each of these has (``Comp``, ``n_rows``), computed when it is read.
    """
    raw = drop_junk_columns(read_csv_union(spark, folder, glob or f"*_{stat}_{level}.csv"))
    keyed = with_file_keys(raw, pattern).drop(SOURCE)
    country = map_value(F.col("Comp"), COMP_COUNTRY if countries is None else countries, "null")
    df = stamp(keyed, Gender=gender, Tier=tier).withColumn("Country", country)
    unmapped = df.filter(F.col("Country").isNull()).groupBy("Comp").agg(F.count(F.lit(1)).alias("n_rows"))
    df = df.filter(F.col("Country").isNotNull())
    sort = [c for c in ("Season_End_Year", "Squad", "Player") if c in df.columns and (c != "Player" or level == "player")]
    # ranges over the sort columns split a hot league over several files
    ranged = df.repartitionByRange(*LEAGUE_KEYS, *sort, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ranged = ranged.sortWithinPartitions(*LEAGUE_KEYS, *sort)
    writer = ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LEAGUE_KEYS).parquet(out)
    return unmapped


def historical_results(
    spark: SparkSession,
    folder: str,
    first: int,
    last: int,
    glob: str = "s_*.csv",
    pattern: str = "s_{Season}_*.csv",
) -> DataFrame:
    """Season files ``s_{label}_{league}.csv`` of a span of years, stamped with their season."""
    raw = with_file_keys(read_csv_union(spark, folder, glob), pattern).drop(SOURCE)
    years = spark.range(first, last + 1).select(season_label(F.col("id")).alias("Season"))
    return drop_all_null_columns(raw.join(F.broadcast(years), "Season", "left_semi"))


def conform_competitions(df: DataFrame, names: dict | None = None, table: dict | None = None) -> DataFrame:
    """Gender, Country and Tier by competition name; dates; the season's first year.

    The league is looked up by the name as found, and the name is then replaced.
    An unknown name stays in the looked-up columns, as it stays in the name.
    """
    names = COMPETITION_NAMES if names is None else names
    table = COMPETITIONS if table is None else table
    name = F.col("Competition_Name")
    date = parse_date(F.col("Date"), df.schema["Date"].dataType)
    parts = {part: {k: v[i] for k, v in table.items()} for i, part in enumerate(("Country", "Gender", "Tier"))}
    return df.withColumns(
        {
            **{part: map_value(name, lookup, "keep") for part, lookup in parts.items()},
            "Competition_Name": map_value(name, names, "keep"),
            "Date": date,
            "Season_End_Year": season_start_year(date).cast("bigint"),
        }
    )


def sort_competitions(df: DataFrame, columns: Sequence[str] = ("Date", "Country", "Tier", "Round", "Wk")) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_first(c) for c in columns if c in df.columns])
