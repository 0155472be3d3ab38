"""URLs, lookups, casts and rules about expected statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.schemas import FAMILIES


def quoted(name: str) -> Column:
    """A column whose name may hold dots, spaces or signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def url_segment(url: Column, n: int) -> Column:
    """The ``n``-th path segment; negative counts from the end; null if absent."""
    return F.try_element_at(F.split(url, "/"), F.lit(n))


def page_path(country: Column, url: Column, root: str = "stage/html") -> Column:
    return F.concat(F.lit(root + "/"), country, F.lit("/"), url_segment(url, -1), F.lit(".html"))


def map_value(column: Column, mapping: dict, default: str = "keep") -> Column:
    """Look a value up; unmapped values are kept, become null, or raise an error."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, column)
    if default == "null":
        return found
    if default == "keep":
        return F.coalesce(found, column)
    if default == "error":
        problem = F.concat(F.lit("no mapping for "), F.coalesce(column.cast("string"), F.lit("null")))
        return F.when(found.isNotNull(), found).otherwise(F.raise_error(problem))
    raise ValueError(f"unknown default {default!r}")


def to_double(column: Column) -> Column:
    """Number text to double; dirty cells and NaN become null."""
    return F.nullif(column.try_cast("double"), F.lit(float("nan")))


def float_to_int(column: Column) -> Column:
    """Number text to long by way of double, cutting the fraction off."""
    return to_double(column).try_cast("bigint")


def cast_to(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.LongType):
        return float_to_int(column)
    if isinstance(data_type, T.DoubleType):
        return to_double(column)
    return column.try_cast(data_type)


def has_advanced(season: Column, minimum: Column) -> Column:
    return F.coalesce(season >= minimum, F.lit(False))


def expected_families(season: Column, tier: Column) -> Column:
    """All families in the top two tiers since they are published, else summary only."""
    full = ((season > 2017) & (tier == "1st")) | ((season > 2018) & (tier == "2nd"))
    every = F.array(*[F.lit(f) for f in FAMILIES])
    return F.when(full, every).otherwise(F.array(F.lit("summary")))
