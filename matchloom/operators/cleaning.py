"""Selections, filters and repairs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions import cast_to, float_to_int, parse_date, quoted, to_double
from matchloom.schemas import Field, family_types

SENTINEL = "NA_character_"


def select_declared(df: DataFrame, fields: Sequence[Field | str]) -> DataFrame:
    names = [f if isinstance(f, str) else f.name for f in fields]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*map(quoted, names))


def stamp(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in constants.items()})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def entity_rows(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(quoted(key) == F.lit(value))


def valid_matches(results: DataFrame, url: str = "MatchURL", notes: str = "Notes") -> DataFrame:
    """Drop head-to-head pages, play-offs, cancelled matches and rows without a URL."""
    return results.filter(
        ~quoted(url).contains("History")
        & ~quoted(url).contains("RelegationPromotion-Play-offs")
        & ~F.coalesce(quoted(notes), F.lit("")).contains("Cancelled")
    )


def drop_empty_stat_rows(
    df: DataFrame, stats: str | Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Drop rows whose present stat columns are all null.

    ``stats`` is a family name or a list of columns. With an ``observation`` the
    number of dropped rows is counted while the result is computed.
    """
    wanted = family_types(stats) if isinstance(stats, str) else stats
    present = [c for c in df.columns if c in set(wanted)]
    if not present:
        return df
    filled = F.coalesce(*[quoted(c).cast("string") for c in present]).isNotNull()
    if observation is not None:
        df = df.observe(observation, F.count_if(~filled).alias("dropped"))
    return df.filter(filled)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value, found in one pass over all columns."""
    counts = df.agg(*[F.count(quoted(c)).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if counts[i] > 0])


def drop_junk_columns(df: DataFrame, pattern: str = r"^Unnamed|^$|^_c\d+$|^index$") -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not re.search(pattern, c)])


def coalesce_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Fold alternate spellings (key) into the canonical column (value)."""
    found = {alias: name for alias, name in aliases.items() if alias in df.columns}
    folded: dict[str, list[Column]] = {}
    for alias, name in found.items():
        folded.setdefault(name, [quoted(name)] if name in df.columns else []).append(quoted(alias))
    kept = [
        F.coalesce(*folded[c]).alias(c) if c in folded else quoted(c) for c in df.columns if c not in found
    ]
    added = [F.coalesce(*cols).alias(n) for n, cols in folded.items() if n not in df.columns]
    return df.select(*kept, *added)


def canonical_match_url(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Put the match's own URL into MatchURL, keeping the column order.

    ``Game_URL`` is it where present; else ``mapping`` (MatchURL, Game_URL) gives
    it and rows without a mapping are dropped.
    """
    if "MatchURL" not in df.columns:
        return df
    order = df.columns
    if "Game_URL" not in order:
        df = df.join(mapping.select("MatchURL", "Game_URL").distinct(), "MatchURL", "inner")
    return df.withColumn("MatchURL", F.col("Game_URL")).select(*map(quoted, order))


def clean_sentinels(df: DataFrame, mode: str = "whole", sentinel: str = SENTINEL) -> DataFrame:
    """Blank the sentinel: where it is the whole value, or wherever it stands."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    if mode == "whole":
        fix = {c: F.when(quoted(c) == sentinel, "").otherwise(quoted(c)) for c in strings}
    elif mode == "substring":
        fix = {c: F.replace(quoted(c), F.lit(sentinel), F.lit("")) for c in strings}
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.select(*[fix[c].alias(c) if c in fix else quoted(c) for c in df.columns])


def conform(df: DataFrame, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that fit the declared table and those that do not.

    The column set must match. Values are coerced, defaults fill nulls, and a row
    is refused for a value that cannot be coerced or a null where none may be.
    The refused rows keep their raw values and list why in ``violations``.
    """
    names = [f.name for f in fields]
    if set(names) != set(df.columns):
        missing = sorted(set(names) - set(df.columns))
        extra = sorted(set(df.columns) - set(names))
        raise ValueError(f"columns differ from the declared ones: missing {missing}, extra {extra}")
    source = {f.name: f.dataType for f in df.schema.fields}
    coerced, checks = [], []
    for f in fields:
        raw = quoted(f.name)
        if isinstance(f.type, T.DateType):
            value = parse_date(raw, source[f.name])
            bad = raw.isNotNull() & value.isNull()
        elif isinstance(f.type, T.LongType):
            number = to_double(raw)
            # whole numbers beyond 2^53 must not pass through double
            exact = raw.cast("decimal(38,0)") if isinstance(source[f.name], T.DecimalType) else raw
            value = F.coalesce(exact.try_cast("bigint"), float_to_int(raw))
            blank = raw.isNull() | F.isnan(raw.try_cast("double"))
            bad = ~F.coalesce(blank, F.lit(False)) & (value.isNull() | (number != F.floor(number)))
        elif isinstance(f.type, T.DoubleType):
            value = to_double(raw)
            bad = raw.isNotNull() & raw.try_cast("double").isNull()
        else:
            value = raw.cast(f.type)
            bad = raw.isNotNull() & value.isNull()
        if f.default is not None:
            value = F.coalesce(value, F.lit(f.default).cast(f.type))
        coerced.append(F.when(~bad, value).alias(f.name))
        checks.append(F.when(bad, F.lit(f.name + ": type")))
        if not f.nullable:
            checks.append(F.when(~bad & value.isNull(), F.lit(f.name + ": null")))
    judged = df.withColumn("violations", F.array_compact(F.array(*checks)))
    good = judged.filter(F.size("violations") == 0).select(*coerced)
    return good, judged.filter(F.size("violations") > 0)


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    fix = {c: F.coalesce(quoted(c), F.lit(value).cast(df.schema[c].dataType)) for c in numeric}
    return df.select(*[fix[c].alias(c) if c in fix else quoted(c) for c in df.columns])


def _canonical(value: Column, kind: T.DataType) -> Column:
    """A value that is hashed, compared and grouped as its kind is equal: entries of maps sorted, nulls in their place."""

    def marked(v: Column, k: T.DataType) -> Column:
        return F.struct(v.isNull().alias("n"), _canonical(v, k).alias("v"))

    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)  # one zero, whatever its sign
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: marked(v, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = [marked(value[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else value
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(marked(e["key"], kind.keyType).alias("k"), marked(e["value"], kind.valueType).alias("v"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    return value


def _row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row, equal for rows that are equal, with nulls in their place, as decimals that can be added up."""
    parts = []
    for c in sorted(columns):
        parts += [quoted(c).isNull(), _canonical(quoted(c), df.schema[c].dataType)]
    return [F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)") for seed in (1, 2)]


def fingerprints(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per group ``rows`` and two sums of row hashes, ``sum_1`` and ``sum_2``; without keys, one row for all.

    Frames that are equal as multisets of rows have equal fingerprints in whatever order and partitions, and others
    the same one only by a chance of 2^-128. Sums combine before a shuffle, which carries a row for each group and
    partition and none of the columns. Columns take part by name; arrays, structs and maps may be among them.
    """
    one, two = _row_hashes(df, [c for c in df.columns if c not in keys])
    return df.groupBy(*map(quoted, keys)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(one), F.lit(0)).cast("decimal(38,0)").alias("sum_1"),
        F.coalesce(F.sum(two), F.lit(0)).cast("decimal(38,0)").alias("sum_2"),
    )


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with ``surplus`` > 0 for ``a``.

    All columns are shuffled to group by rows: ask ``frames_differ`` first. Rows with maps are grouped by the maps'
    sorted entries.
    """
    names = a.columns
    both = a.withColumn("surplus", F.lit(1)).unionByName(b.withColumn("surplus", F.lit(-1)))
    surplus = F.sum("surplus").cast("bigint").alias("surplus")
    mapped = [f.name for f in a.schema.fields if "map<" in f.dataType.simpleString()]
    plain = [c for c in names if c not in mapped]
    keys = [_canonical(quoted(c), a.schema[c].dataType).alias(f"_map{i}") for i, c in enumerate(mapped)]
    values = [F.first(quoted(c)).alias(c) for c in mapped]
    grouped = both.groupBy(*map(quoted, plain), *keys).agg(surplus, *values)
    return grouped.filter(F.col("surplus") != 0).select(*map(quoted, names), "surplus")


def frames_differ(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames differ as multisets of rows, or in columns or types; by fingerprints, so no row is shuffled."""

    def shape(df: DataFrame):
        return {(f.name, f.dataType.simpleString()) for f in df.schema.fields}

    return shape(a) != shape(b) or fingerprints(a).first() != fingerprints(b).first()


def key_coverage(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole keys on one side only: ``lost`` by cleaning or ``gained`` by it."""
    cols = list(map(quoted, keys))
    marked = (
        before.select(*cols, F.lit(1).alias("_before"), F.lit(0).alias("_after"))
        .unionAll(after.select(*cols, F.lit(0).alias("_before"), F.lit(1).alias("_after")))
        .dropna(subset=list(keys))
    )
    seen = marked.groupBy(*cols).agg(F.max("_before").alias("_before"), F.max("_after").alias("_after"))
    change = F.when(F.col("_before") == 1, "lost").otherwise("gained").alias("change")
    return seen.filter(F.col("_before") != F.col("_after")).select(*cols, change)


def fix_team_names(
    df: DataFrame, corrections: dict[str, dict[str, str]], url: str = "MatchURL", country: str = "Country"
) -> DataFrame:
    """Correct misspelt team names inside the URL, per country."""
    fixed = quoted(url)
    for name, pairs in corrections.items():
        for old, new in pairs.items():
            fixed = F.when(quoted(country) == name, F.replace(fixed, F.lit(old), F.lit(new))).otherwise(fixed)
    return df.withColumn(url, fixed)


_COMMON_CASTS = {
    "Home_xG": T.DoubleType(),
    "Away_xG": T.DoubleType(),
    "Season_End_Year": T.LongType(),
    "Min": T.DoubleType(),
    "Home_Score": T.LongType(),
    "Away_Score": T.LongType(),
}


def select_stat_columns(
    df: DataFrame,
    family: str,
    level: str,
    keys: Sequence[str],
    match_keys: Sequence[str],
    distinct: bool = True,
) -> DataFrame:
    """Rows of one family at team or player level: keys and its statistics.

    Rows are made distinct, which costs a shuffle; a caller that takes maxima or
    distinct rows later can leave that out.
    """
    stats = family_types(family)
    casts = {**_COMMON_CASTS, **stats}
    wanted = [*keys, *[c for c in match_keys if c not in keys]]
    if level == "team":
        person = {"Player_Href", "Min"} | ({"Player", "Nation", "Age"} if family == "keeper" else set())
        wanted = [c for c in wanted if c not in person]
    wanted += [c for c in df.columns if c in stats and c not in wanted]
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(c: str) -> Column:
        if c not in casts or (have.get(c) == casts[c] and not isinstance(casts[c], T.DoubleType)):
            return quoted(c)
        return cast_to(quoted(c), casts[c]).alias(c)

    chosen = df.select(*map(typed, wanted))
    return chosen.distinct() if distinct else chosen
