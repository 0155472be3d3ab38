"""Edge cases of column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom import functions as fn
from matchloom.schemas import FAMILIES, FAMILY_COLUMNS, LEAGUES, MATCH_KEYS, MATCH_SUMMARY, TEAM_KEYS, family_types


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_seasons_turn_after_their_last_month(spark):
    days = [dt.date(2020, m, 1) for m in (6, 7, 8)] + [None]
    assert values(spark, fn.season_end_year, days, "date") == [2020, 2020, 2021, None]
    assert values(spark, lambda c: fn.season_end_year(c, 6), days, "date") == [2020, 2021, 2021, None]
    assert values(spark, fn.season_start_year, days, "date") == [2019, 2020, 2020, None]
    assert [fn.current_season(dt.date(2020, m, 1)) for m in (6, 7, 8)] == [2020, 2021, 2021]


def test_dates_from_text_and_day_counts(spark):
    day = dt.date(2020, 8, 1)
    text = ["2020-08-01", "18475", "18475.0", "soon", "2020-13-01", "", None, "2020"]
    expected = [day, day, day, None, None, None, None, dt.date(1975, 7, 14)]
    assert values(spark, fn.parse_date, text) == expected
    assert values(spark, lambda c: fn.parse_date(c, T.DoubleType()), [18475.0, None], "double") == [day, None]


def test_season_names(spark):
    assert values(spark, fn.season_label, [1993, 1999, 2009], "int") == ["9394", "9900", "0910"]
    assert values(spark, fn.season_slug, [2024], "int") == ["2023-2024"]


def test_url_parts(spark):
    urls = ["https://x/en/matches/ab12/Name", "one", None]
    assert values(spark, lambda c: fn.url_segment(c, -2), urls) == ["ab12", None, None]
    path = values(spark, lambda c: fn.page_path(F.lit("ENG"), c), urls)
    assert path == ["stage/html/ENG/Name.html", "stage/html/ENG/one.html", None]


def test_map_value_modes(spark):
    mapping = {"a": "A"}
    assert values(spark, lambda c: fn.map_value(c, mapping), ["a", "b", None]) == ["A", "b", None]
    assert values(spark, lambda c: fn.map_value(c, mapping, "null"), ["a", "b"]) == ["A", None]
    with pytest.raises(Exception, match="no mapping for b"):
        values(spark, lambda c: fn.map_value(c, mapping, "error"), ["b"])


def test_numbers(spark):
    cells = ["2.7", "-2.7", "x", "NaN", "", None, "1e3"]
    assert values(spark, fn.float_to_int, cells) == [2, -2, None, None, None, None, 1000]
    assert values(spark, fn.to_double, cells) == [2.7, -2.7, None, None, None, None, 1000.0]


def test_formation(spark):
    heads = ["Arsenal (4-3-3)", "Milan (4-1-2-1-2◆)", "Milan (4-1-2-1-2<U+25C6>)", "Milan..4.4.2.", "None"]
    assert values(spark, fn.formation, heads) == ["4-3-3", "4-1-2-1-2-diamond", "4-1-2-1-2-diamond", "4-4-2", ""]


LINES = [
    "45+2&rsquor; 1:0 Ann Lee Assist: Bo — Goal 1:0",
    "46&rsquor; Bo — Yellow Card",
    "90&rsquor; 2:1 Cy — Penalty Kick 2:1",
    "91&rsquor; 2:2 Cy — Own Goal",
    "105&rsquor; Di — Red Card",
    "106&rsquor; Di — Substitute",
    "120&rsquor; 10:2 Ed — Goal",
    "121&rsquor; Ed — Goal",
    "P 1&rsquor; 3 Fay 1:0 — Penalty",
    "x&rsquor; Gus — Goal",
]


def test_event_times(spark):
    minutes = [47, 46, 90, 91, 105, 106, 120, 121, 121, None]
    assert values(spark, fn.event_minute, LINES) == minutes
    assert values(spark, fn.event_half, LINES) == [1, 2, 2, 3, 3, 4, 4, 5, 5, 5]
    assert values(spark, fn.is_shootout, LINES) == [False] * 8 + [True, False]


def test_event_parts(spark):
    kinds = ["Goal", "Yellow Card", "Penalty", "Own Goal", "Red Card", "Substitute", "Goal", "Goal"]
    assert values(spark, fn.event_type, LINES) == [*kinds, "Penalty Shootout", "Goal"]
    scores = ["1:0", None, "2:1", "2:2", None, None, "0:2", None, "1:0", None]
    assert values(spark, fn.score_progression, LINES) == scores
    people = values(spark, fn.event_players, LINES)
    # a score has one digit on each side, so the first digit of 10:2 stays, joined to what follows
    assert people == ["Ann Lee Assist: Bo", "Bo", "Cy", "Cy", "Di", "Di", "Ed", "Ed", "Fay", "Gus"]
    assert values(spark, fn.penalty_number, LINES) == [None] * 8 + [3.0, None]


def test_squish(spark):
    assert values(spark, fn.squish, ["  a \t b\n c ", "", None]) == ["a b c", "", None]


def test_expected_families(spark):
    rows = [(2017, "1st"), (2018, "1st"), (2018, "2nd"), (2019, "2nd"), (2019, "3rd")]
    df = spark.createDataFrame(rows, "s int, t string")
    sizes = [len(r[0]) for r in df.select(fn.expected_families(F.col("s"), F.col("t"))).collect()]
    assert sizes == [1, 7, 1, 7, 1]


def test_declared_tables():
    assert [len(family_types(f)) for f in FAMILIES] == [25, 20, 37, 15, 22, 16, 16]
    assert all(len(set(family_types(f))) == len(family_types(f)) for f in FAMILY_COLUMNS)
    assert len(MATCH_SUMMARY) == 33 and len(MATCH_KEYS) == 23 and len(LEAGUES) == 10
    assert TEAM_KEYS == ["MatchURL", "Team", "Home_Away", "Gender", "Country", "Tier", "Season_End_Year"]
    away = next(f for f in MATCH_SUMMARY if f.name == "Away_Score")
    assert (away.nullable, away.default) == (True, 0)
