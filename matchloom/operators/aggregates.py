"""Grouped aggregates. All combine on the map side, so a hot group is cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import quoted
from matchloom.operators.cleaning import valid_matches


def collapse(df: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """The maximum of every other column per key; nulls are skipped, null keys group."""
    values = [c for c in df.columns if c not in keys] if values is None else values
    return df.groupBy(*map(quoted, keys)).agg(*[F.max(quoted(c)).alias(c) for c in values])


def wage_totals(wages: DataFrame) -> DataFrame:
    pay = F.col("WeeklyWageGBP")
    return wages.groupBy("Comp", "Team", "Season").agg(
        F.coalesce(F.sum(pay), F.lit(0.0)).alias("TotalWages"), F.avg(pay).alias("AvgWages")
    )


def counts_by(df: DataFrame, keys: Sequence[str], distinct_on: Sequence[str] | None = None) -> DataFrame:
    """Rows per group; or distinct combinations of ``distinct_on`` per group."""
    if distinct_on is not None:
        df = df.select(*map(quoted, dict.fromkeys([*keys, *distinct_on]))).distinct()
    return df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("len"))


def null_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*map(quoted, keys)).agg(
        *[F.avg(quoted(c).isNull().cast("int")).alias(c) for c in rest]
    )


def null_profile_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least, greatest and mean null share over the columns of each group.

    A group is one row of the profile, so this is arithmetic within the row.
    """
    profile = null_profile(df, keys)
    rest = [c for c in df.columns if c not in keys]
    shares = F.array(*map(quoted, rest))
    total = reduce(Column.__add__, map(quoted, rest))
    return profile.select(
        *map(quoted, keys),
        F.array_min(shares).alias("Min"),
        F.array_max(shares).alias("Max"),
        (total / len(rest)).alias("Avg"),
    ).orderBy("Avg")


def share_true(df: DataFrame, predicate: Column, date: Column, bucket: str = "day") -> DataFrame:
    """The share of rows that satisfy a predicate, per day or per month end."""
    when = {"day": date.cast("date"), "month": F.last_day(date)}[bucket]
    return df.groupBy(when.alias("Date")).agg(F.avg(predicate.cast("int")).alias("share"))


def n_unique(df: DataFrame, column: str, where: Column | None = None, approximate: bool = False) -> DataFrame:
    if where is not None:
        df = df.filter(where)
    values = quoted(column)
    count = F.approx_count_distinct(values) if approximate else F.count_distinct(values)
    # null counts as one value of its own
    null = F.coalesce(F.max(values.isNull().cast("int")), F.lit(0))
    return df.agg((count + null).cast("bigint").alias("n_unique"))


def entity_catalog(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Sorted distinct entities over all tables that have the column."""
    parts = [df.select(quoted(column)).distinct() for df in tables.values() if column in df.columns]
    if not parts:
        raise ValueError(f"no table has a column {column!r}")
    return reduce(DataFrame.unionAll, parts).distinct().orderBy(F.asc_nulls_first(quoted(column)))


def coverage_pivot(files: DataFrame, stat: str, tier: str, countries: Sequence[str]) -> DataFrame:
    """Files per year (rows) and country (columns) of one statistic and tier."""
    return (
        files.filter((F.col("stat") == stat) & (F.col("tier") == tier))
        .groupBy("year")
        .pivot("country", list(countries))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def wage_history(wages: DataFrame, key: str, value: str, by: str) -> DataFrame:
    """Annual wages of a team by player, or of a player by team, per season."""
    return (
        wages.filter(quoted(key) == F.lit(value))
        .groupBy("Season", by)
        .agg(F.sum("AnnualWageGBP").alias("AnnualWageGBP"))
        .orderBy("Season", by)
    )


def player_career(stats: DataFrame, player: str, measures: Sequence[str], season: str = "Season_End_Year"):
    return (
        stats.filter(F.col("Player") == F.lit(player))
        .select(quoted(season), *map(quoted, measures))
        .orderBy(quoted(season))
    )


def load_progress(results: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per league and season: expected, loaded and remaining matches."""
    expected = valid_matches(results).select(*keys, "MatchURL").distinct()
    loaded = summary.select("MatchURL").distinct().withColumn("loaded", F.lit(1))
    return (
        expected.join(loaded, "MatchURL", "left")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("expected"), F.count("loaded").alias("loaded"))
        .withColumn("remaining", F.col("expected") - F.col("loaded"))
    )
