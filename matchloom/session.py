"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the wide tables make generated methods the JVM would never compile: split those
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_base: str | None = None


def build_session(app_name: str = "matchloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="matchloom-")
        base = _local_base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Cuts the lineage for iterative jobs, and survives the loss of an executor
    because the rows live in the shared folder. Large tables that are written once
    may name a ``compression`` that takes less room than the session's.
    """
    path = work_folder(df.sparkSession, label)
    options = {"compression": compression} if compression else {}
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
