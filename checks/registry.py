"""Registration, table loading and SQL that both engines read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def run(spark: SparkSession, directory: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL whose tables stand in braces, such as ``FROM {orders}``."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    tables = {n: frames[n] if n in frames else load(spark, directory, n) for n in names}
    return spark.sql(sql, **tables)


def plain(sql: str) -> str:
    """The same SQL for an engine that knows the tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def with_tables(select: str, **tables: str) -> str:
    """``select`` after a WITH clause of named inputs."""
    parts = ", ".join(f"{name} AS ({plain(sql)})" for name, sql in tables.items())
    return f"WITH {parts} {select}" if tables else select


def check(name: str, sql: str | None = None, **tables: str):
    """Register a query and, with ``sql``, its oracle over the named inputs."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_tables(sql, **tables)
        return function

    return register
