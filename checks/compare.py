"""Compare registered queries with their oracles: ``python -m checks.compare DIR [NAME...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

from checks.registry import ORACLES, QUERIES, TABLES


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = round(float(value), 6)
        return int(number) if number == int(number) else number
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    return names, result.fetchall()


def connect(directory: str):
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return connection


def compare(spark, connection, directory: str, name: str) -> str | None:
    """None where both agree, else what differs."""
    df = QUERIES[name](spark, directory)
    rows = df.collect()
    if name not in ORACLES:
        return None if rows else "no rows"
    names, expected = oracle_rows(connection, ORACLES[name])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but {sorted(names)} expected"
    a, b = rows_of(df.columns, rows), rows_of(names, expected)
    if a == b:
        return None if a else "no rows on both sides"
    only_a, only_b = sorted(set(a) - set(b), key=repr)[:3], sorted(set(b) - set(a), key=repr)[:3]
    return f"{len(a)} rows, {len(b)} expected; columns {sorted(names)}; only here {only_a}; only there {only_b}"


def main() -> None:
    from matchloom.session import build_session

    directory, wanted = sys.argv[1], sys.argv[2:]
    local = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    spark = build_session("checks", "local[8]", **local)
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(directory)
    bad = 0
    for name in QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, directory, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "BAD "
        note = "" if name in ORACLES else " (rows only)"
        print(f"{mark}{name} {time.time() - start:.2f}s{note} {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    import checks  # noqa: F401

    main()
