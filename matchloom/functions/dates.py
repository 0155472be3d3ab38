"""Seasons and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def season_end_year(date: Column, last_month: int = 7) -> Column:
    """The year a season ends in; ``last_month`` is its last calendar month."""
    return F.when(F.month(date) <= last_month, F.year(date)).otherwise(F.year(date) + 1)


def season_start_year(date: Column) -> Column:
    return F.when(F.month(date) > 6, F.year(date)).otherwise(F.year(date) - 1)


def current_season(today: dt.date) -> int:
    return today.year if today.month < 7 else today.year + 1


def parse_date(column: Column, data_type: T.DataType = T.StringType()) -> Column:
    """A date from ISO text or from a count of days since 1970-01-01.

    Text that is a plain number is a day count too, since a CSV cell has no type
    of its own. Anything else becomes null.
    """
    if isinstance(data_type, T.DateType):
        return column
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("date")
    if isinstance(data_type, T.NumericType):
        return F.date_from_unix_date(column.cast("double").cast("int"))
    text = F.trim(column)
    return F.when(
        text.rlike(r"^-?\d+(\.\d+)?$"), F.date_from_unix_date(text.try_cast("double").try_cast("int"))
    ).when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))


def month_end(date: Column) -> Column:
    return F.last_day(date)


def season_label(year: Column) -> Column:
    """``1993`` becomes ``9394``."""
    short = [F.lpad((y % 100).cast("string"), 2, "0") for y in (year, year + 1)]
    return F.concat(*short)


def season_slug(season: Column) -> Column:
    """``2024`` becomes ``2023-2024``."""
    return F.concat((season - 1).cast("string"), F.lit("-"), season.cast("string"))
