"""Profiles of appended tables that are kept up to date by reading new batches only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import quoted
from matchloom.sources.files import list_files


def batch_numbers(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the batches that stand below ``base``; no rows are read."""
    found = F.regexp_extract("path", r"/batch=(\d+)/[^/]+\.parquet$", 1)
    try:
        numbers = list_files(spark, base).select(found.alias("n")).filter("n <> ''").distinct().collect()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted(int(r["n"]) for r in numbers)


def profile_state(df: DataFrame, keys: Sequence[str], distinct: str | None = None) -> DataFrame:
    """What a batch adds: per group and column the rows that have a value, and on a row without column all rows.

    That row also has a sketch of the different values of ``distinct``. States of batches are added up, sketches
    are united; a column that a batch does not have has no value in it.
    """
    rest = [c for c in df.columns if c not in keys]
    sketch = F.hll_sketch_agg(quoted(distinct).cast("string")) if distinct in df.columns else F.lit(None).cast("binary")
    counted = df.groupBy(*map(quoted, keys)).agg(
        F.count(F.lit(1)).alias("_rows"), sketch.alias("_sketch"), *[F.count(quoted(c)).alias(f"_{i}") for i, c in enumerate(rest)]
    )
    entries = [F.struct(F.lit(None).cast("string").alias("column"), F.col("_rows").alias("filled"), F.col("_sketch").alias("sketch"))]
    entries += [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("filled"), F.lit(None).cast("binary").alias("sketch")) for i, c in enumerate(rest)]
    return counted.select(*map(quoted, keys), F.inline(F.array(*entries)))


def update_profile(spark: SparkSession, base: str, state: str, keys: Sequence[str], distinct: str | None = None) -> list[int]:
    """Add the batches that ``state`` lacks; their numbers. Each has a folder of its own, so a repeated run adds nothing twice."""
    new = sorted(set(batch_numbers(spark, base)) - set(batch_numbers(spark, state)))
    for n in new:
        rows = spark.read.option("mergeSchema", "true").parquet(f"{base}/batch={n:04d}")
        profile_state(rows, keys, distinct).write.mode("overwrite").parquet(f"{state}/batch={n:04d}")
    return new


def read_profile(spark: SparkSession, state: str, keys: Sequence[str]) -> DataFrame:
    """Per group ``rows``, the null share of every column of any batch, and ``distinct_values`` as the sketches estimate it.

    Reads the state alone: a row for each batch, group and column.
    """
    found = spark.read.parquet(state)
    columns = [r["column"] for r in found.select("column").distinct().filter("column IS NOT NULL").orderBy("column").collect()]
    rows = F.sum(F.when(F.col("column").isNull(), F.col("filled")))
    shares = [(1 - F.coalesce(F.sum(F.when(F.col("column") == c, F.col("filled"))), F.lit(0)) / rows).alias(c) for c in columns]
    estimate = F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("column").isNull(), F.col("sketch")))).alias("distinct_values")
    return found.groupBy(*map(quoted, keys)).agg(rows.alias("rows"), *shares, estimate)
