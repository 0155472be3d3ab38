"""Joins. Sides are left to the optimiser, which broadcasts by measured size."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import page_path, quoted, url_segment
from matchloom.operators.aggregates import collapse
from matchloom.operators.cleaning import valid_matches
from matchloom.operators.unions import relaxed_union
from matchloom.schemas import FIRST_SEASON, league_config
from matchloom.session import materialize


def with_league_config(
    df: DataFrame,
    gender: str | None = "M",
    config: DataFrame | None = None,
    first_season: int = FIRST_SEASON,
) -> DataFrame:
    """Keep rows of followed leagues since the first season, with their minimum."""
    if config is None:
        config = F.broadcast(league_config(df.sparkSession))
    joined = df.filter(F.col("Season_End_Year") >= first_season)
    if gender is not None:
        joined = joined.filter(F.col("Gender") == gender)
    return joined.join(config, ["Country", "Tier"], "inner")


def in_tasks(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Rows dealt by ``key`` to so many tasks; without ``tasks`` as many as the session has shuffle partitions.

    Left to itself Spark merges partitions by their compressed size. URLs and keys in order compress so well that a
    join of them would run in a task for each core, and its sorts and maps would grow with the whole input.
    """
    return df.repartition(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), quoted(key))


def with_presence_flags(results: DataFrame, key: str = "MatchURL", **key_sets: DataFrame) -> DataFrame:
    """A boolean per named key set: does the row's key occur in it?

    The sets are merged first (one row per key with one flag per set), so the
    results shuffle once however many sets there are, to as many tasks as the session names.
    """
    marked = relaxed_union(
        [df.select(quoted(key)).withColumn(name, F.lit(True)) for name, df in key_sets.items()]
    )
    flags = marked.filter(quoted(key).isNotNull()).groupBy(key).agg(*[F.max(n).alias(n) for n in key_sets])
    return in_tasks(results, key).join(flags, key, "left").withColumns(
        {n: F.coalesce(F.col(n), F.lit(False)) for n in key_sets}
    )


def missing_matches(
    results: DataFrame,
    summary: DataFrame,
    team_summary: DataFrame,
    team_advanced: DataFrame,
    gender: str | None = "M",
    config: DataFrame | None = None,
    first_season: int = FIRST_SEASON,
) -> DataFrame:
    """Valid matches that lack a summary, team summary or due advanced statistics."""
    known = with_league_config(valid_matches(results), gender, config, first_season)
    flagged = with_presence_flags(
        known, InMatchSummary=summary, InTeamSummary=team_summary, InTeamAdvanced=team_advanced
    )
    advanced_due = F.coalesce(F.col("Season_End_Year") >= F.col("Min_Advanced_Season"), F.lit(False))
    lacking = ~F.col("InMatchSummary") | ~F.col("InTeamSummary") | (~F.col("InTeamAdvanced") & advanced_due)
    return flagged.filter(lacking).withColumn("filename", page_path(F.col("Country"), F.col("MatchURL")))


def attach_league_by_match_id(stats: DataFrame, matches: DataFrame) -> DataFrame:
    """Left join on the id inside the URL; the known match's URL replaces the row's."""
    league = [c for c in matches.columns if c != "MatchURL"]
    right = matches.withColumn("match_id", url_segment(F.col("MatchURL"), -2))
    left = stats.withColumn("match_id", url_segment(F.col("MatchURL"), -2)).drop("MatchURL")
    kept = [c for c in left.columns if c != "match_id"]
    new = ["MatchURL", *[c for c in league if c not in kept]]
    return left.join(right.select("match_id", *new), "match_id", "left").select(*map(quoted, [*kept, *new]))


def attach_league(df: DataFrame, matches: DataFrame) -> DataFrame:
    """Left join on MatchURL; a column both sides have stays the left one."""
    new = [c for c in matches.columns if c not in df.columns]
    return df.join(matches.select("MatchURL", *new), "MatchURL", "left")


def league_from_competition(summary: DataFrame, competitions: DataFrame) -> DataFrame:
    """Country, Gender and Tier of a summary from its league's name."""
    right = competitions.select(
        F.col("Competition_Name").alias("League"), "Country", "Gender", "Tier"
    ).distinct()
    left = summary.drop("Country", "Gender", "Tier", "Competition_Name")
    return left.join(right, "League", "left").withColumn("Competition_Name", F.col("League"))


def _own_columns(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> list[DataFrame]:
    """Each frame without the columns an earlier one supplies."""
    seen: set[str] = set()
    out = []
    for df in frames.values():
        own = [c for c in df.columns if c not in keys and c not in seen]
        seen.update(own)
        out.append(df.select(*map(quoted, [c for c in df.columns if c in keys or c in own])))
    return out


def join_families(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of all families on all keys; earlier families win a name.

    Repeated rows of the first family stay, those of the others count once. A null key matches nothing: its rows stay
    alone. The families are stacked and dealt by their keys in one shuffle, where a chain of full joins would shuffle
    what it has joined so far once for each family. A key's rows are gathered as one list for each family and unfolded
    family by family, so the rows of a single key must fit in memory.
    """
    own = _own_columns(frames, keys)
    lists = [f"_rows_{i}" for i in range(len(own))]
    alone = reduce(Column.__or__, [quoted(k).isNull() for k in keys])
    parts, values = [], []
    for i, (name, df) in enumerate(zip(lists, own, strict=True)):
        values.append([c for c in df.columns if c not in keys])
        row = F.struct(*[quoted(c) for c in values[i]]) if values[i] else F.struct(F.lit(True).alias("_"))
        # rows with a null key are dealt by their values too, and told apart from other families' rows
        parts.append(
            df.select(
                *[quoted(k) for k in keys],
                F.when(alone, F.xxhash64(*map(quoted, df.columns))).otherwise(0).alias("_spread"),
                F.when(alone, i).otherwise(-1).alias("_family"),
                (F.monotonically_increasing_id() if i == 0 else F.lit(-1).cast("bigint")).alias("_copy"),
                row.alias(name),
            )
        )
    # a fixed number of tasks: merged by their compressed size, stacked rows with many nulls would not fit in memory
    tasks = int(parts[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = relaxed_union(parts).repartition(tasks, *map(quoted, keys), "_spread").distinct()
    joined = dealt.groupBy(*map(quoted, keys), "_spread", "_family").agg(*[F.collect_list(c).alias(c) for c in lists])
    for c in lists:
        joined = joined.withColumn(c, F.explode_outer(c))
    fields = [F.col(c)[v].alias(v) for c, names in zip(lists, values, strict=True) for v in names]
    return joined.select(*map(quoted, keys), *fields)


def collapse_families(
    frames: Mapping[str, DataFrame],
    keys: Sequence[str],
    group_keys: Sequence[str],
    drop: Sequence[str] = (),
) -> DataFrame:
    """The result of ``join_families`` and ``collapse`` in a single shuffle.

    ``group_keys`` are some of ``keys``; other keys get their maximum unless they
    are in ``drop``.

    A maximum per group does not change when rows are joined before: every input
    row shows up with its own values and the rest are nulls or repeats. So the
    families are stacked and collapsed at once.
    """
    stacked = relaxed_union(_own_columns(frames, keys))
    extra = [c for c in keys if c not in group_keys and c not in drop]
    return collapse(stacked, group_keys, [*extra, *[c for c in stacked.columns if c not in keys]])


def lineup_with_stats(lineup: DataFrame, summary: DataFrame, on: Sequence[str], side: Column) -> DataFrame:
    """Left join of a line-up to its player statistics; a missing side is filled in."""
    first = ["Matchday", "Team", "Home_Away", "Formation", "Player_Num", "Player_Name", "Starting"]
    right = summary.filter(F.col("Player_Num").isNotNull()).withColumnRenamed("Player", "Player_Name")
    new = [c for c in right.columns if c in on or c not in lineup.columns]
    joined = lineup.withColumn("_side", side).join(right.select(*map(quoted, new)), list(on), "left")
    joined = joined.withColumn("Home_Away", F.coalesce(F.col("Home_Away"), F.col("_side"))).drop("_side")
    order = [c for c in first if c in joined.columns]
    return joined.select(*map(quoted, [*order, *[c for c in joined.columns if c not in order]]))


def orphans(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``; rows without a key are left out."""
    return a.filter(quoted(key).isNotNull()).join(b.select(quoted(key)).distinct(), key, "left_anti")


def _numbered_values(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The distinct values of a column with ``_index`` from 0, and how many there are; nulls are left out.

    Values are numbered within the partitions that hold them, written once with their numbers, and moved by the
    counts of the partitions before; only those counts reach the driver.
    """
    values = df.select(quoted(column)).filter(quoted(column).isNotNull()).distinct()
    kept = materialize(values.withColumn("_id", F.monotonically_increasing_id()), "grid-values")
    part = F.shiftrightunsigned("_id", 33)
    counts = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bases, total = [], 0
    for p, n in sorted(counts.items()):
        bases.append((p, total - (p << 33)))
        total += n
    moved = kept.join(F.broadcast(df.sparkSession.createDataFrame(bases, "_part long, _base long")), part == F.col("_part"))
    return moved.select(quoted(column), (F.col("_id") + F.col("_base")).alias("_index")), total


def completeness_grid(df: DataFrame, dims: Sequence[str], most: int = 10**11) -> DataFrame:
    """All combinations of the values of each dimension, and whether they occur.

    Each dimension's values are numbered; a cell of the grid is one number of a distributed range, whose digits in
    the mixed base of the dimensions' sizes pick the values by equi-joins. Nothing is gathered in one task, whatever
    a dimension's size. The grid is the product of the sizes: above ``most`` cells an error says so before any is made.
    """
    spark, cells, stride, parts = df.sparkSession, 1, 1, []
    for d in dims:
        values, size = _numbered_values(df, d)
        parts.append((d, values, size))
        cells *= size
    if cells > most:
        sizes = ", ".join(f"{d} {size}" for d, _, size in parts)
        raise ValueError(f"the grid has {cells} cells, more than {most}: {sizes}")
    tasks = max(spark.sparkContext.defaultParallelism, cells // 5_000_000)
    grid = spark.range(0, cells, 1, tasks)
    for d, values, size in parts:
        grid = grid.withColumn("_digit", F.expr(f"(id div {stride}) % {max(size, 1)}"))
        grid = grid.join(values, F.col("_digit") == F.col("_index")).drop("_digit", "_index")
        stride *= max(size, 1)
    seen = df.select(*map(quoted, dims)).distinct().withColumn("present", F.lit(True))
    grid = grid.select(*map(quoted, dims)).join(seen, list(dims), "left")
    return grid.withColumn("present", F.coalesce("present", F.lit(False)))


def matches_with_lineups(matches: DataFrame, lineups: DataFrame) -> DataFrame:
    new = [c for c in lineups.columns if c not in matches.columns]
    return matches.join(lineups.select("match_id", *map(quoted, new)), "match_id", "left")


def broadcast_match_header(header: DataFrame, rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Attach the one header row of a page to each of its rows."""
    new = [c for c in header.columns if c == key or c not in rows.columns]
    return rows.join(header.select(*map(quoted, new)), key, "inner")


def ordered_pairs(fixtures: DataFrame, teams: DataFrame) -> DataFrame:
    """Each (home, away) fixture with both teams' parameters; ``all_pairs`` also has the pairs that did not play.

    ``fixtures`` has home, away and goals; ``teams`` has team, attack, defence. A
    pair matters to the model only where a score was observed, so the pairs come
    from the fixtures by two equi-joins and not from crossing the teams.
    """
    played = fixtures.filter(F.col("home") != F.col("away"))

    def as_side(s: str) -> DataFrame:
        return teams.select(
            F.col("team").alias(s), F.col("attack").alias(s + "_attack"), F.col("defence").alias(s + "_defence")
        )

    return played.join(as_side("home"), "home").join(as_side("away"), "away")


def all_pairs(teams: DataFrame, fixtures: DataFrame, blocks: int | None = None, most: int = 10**11) -> DataFrame:
    """Every ordered pair of different teams with both teams' parameters, and the goals of each of their fixtures.

    ``teams`` has team, attack, defence; ``fixtures`` has home, away and goals. A pair that did not play is one row
    with null goals. Teams are dealt to ``blocks`` row and column blocks by a hash; a team goes to its row block once
    for each column block, and the other way round, and sides meet where both blocks agree: an equi-join of
    ``blocks`` squared cells of even size. A home row carries the teams of its column block it played, and those pairs
    come from the fixtures instead. So shuffles carry 2 x ``blocks`` copies of each team and the fixtures, never the
    pairs. The result has n (n - 1) rows; above ``most`` an error says so. Null teams are left out; a team listed
    twice pairs twice. Without ``blocks``, there are as many cells as shuffle partitions, or more so that each has some
    million pairs.
    """
    spark = teams.sparkSession
    sides = teams.filter(F.col("team").isNotNull()).select("team", "attack", "defence")
    n = sides.count()
    if n * (n - 1) > most:
        raise ValueError(f"{n} teams make {n * (n - 1)} pairs, more than {most}")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * n // 4_000_000)
    if blocks is None:
        blocks = max(1, min(math.isqrt(tasks), n))
    own = F.pmod(F.xxhash64("team"), F.lit(blocks))
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def as_side(s: str, row: Column, column: Column) -> DataFrame:
        kept = sides.select(F.col("team").alias(s), F.col("attack").alias(f"{s}_attack"), F.col("defence").alias(f"{s}_defence"), own.alias("_own"))
        return kept.withColumn("_other", others).select(s, f"{s}_attack", f"{s}_defence", row.alias("_row"), column.alias("_column"))

    def named(df: DataFrame) -> DataFrame:
        return df.select("home", "away", "home_attack", "home_defence", "away_attack", "away_defence", "goals")

    kind = sides.schema["team"].dataType
    found = ordered_pairs(fixtures.select("home", "away", "goals"), sides)
    found = found.withColumns({s: F.col(s).cast(kind) for s in ("home", "away")})
    # one row per home and column block that met; the pairs themselves are too many to be joined with the fixtures
    met = found.groupBy("home", F.pmod(F.xxhash64("away"), F.lit(blocks)).alias("_column")).agg(F.collect_set("away").alias("_met"))
    homes = as_side("home", F.col("_own"), F.col("_other").cast("bigint")).join(met, ["home", "_column"], "left")
    aways = as_side("away", F.col("_other").cast("bigint"), F.col("_own"))
    unplayed = (F.col("home") != F.col("away")) & ~F.coalesce(F.array_contains("_met", F.col("away")), F.lit(False))
    # a fixed number of tasks: by the bytes shuffled, which are few, the pairs would be made in one
    homes, aways = (df.repartition(tasks, "_row", "_column") for df in (homes, aways))
    pairs = homes.join(aways.hint("shuffle_hash"), ["_row", "_column"]).filter(unplayed).drop("_row", "_column", "_met")
    none = F.lit(None).cast(found.schema["goals"].dataType)
    return named(pairs.withColumn("goals", none)).unionAll(named(found))
