"""Tables whose parts are replaced at once: new files first, then one rename that publishes them.

A table is a folder with ``data/`` (a folder of files for each write) and ``_manifest/`` (a numbered file for each
version, which names the folder of every part). Files are never changed. Readers take the newest version whole; a write
that breaks off before its rename leaves folders that no version names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import quoted
from matchloom.sources.tables import SORT_CANDIDATES, merge_slices, own_rows

Part = tuple[str, ...]


class VersionConflict(RuntimeError):
    """Another write has replaced the same part meanwhile."""


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, system = _path(spark, f"{path}/_manifest"), _system(spark, path)
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _parts(spark: SparkSession, path: str, number: int) -> dict[Part, str]:
    if not number:
        return {}
    text = spark.read.text(f"{path}/_manifest/{number:012d}", wholetext=True).first()[0]
    return {tuple(p["part"]): p["folder"] for p in json.loads(text)["parts"]}


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 where there is no table."""
    return max(_numbers(spark, path), default=0)


def _publish(spark: SparkSession, path: str, number: int, parts: Mapping[Part, str]) -> bool:
    """Make a version visible by one rename; False if there is one of that number already."""
    system, jvm = _system(spark, path), spark._jvm
    waiting, final = _path(spark, f"{path}/_manifest/.{uuid.uuid4().hex}"), _path(spark, f"{path}/_manifest/{number:012d}")
    out = system.create(waiting, False)
    try:
        body = {"version": number, "parts": [{"part": list(k), "folder": v} for k, v in sorted(parts.items())]}
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # an existing version is not overwritten
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), spark._jsc.hadoopConfiguration()).rename(waiting, final, options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        system.delete(waiting, False)
        return False
    return True


def replace_parts(spark: SparkSession, path: str, frames: Mapping[Part, DataFrame], since: int) -> int:
    """Write the frames as those parts of the next version and publish it; the other parts stay as they are.

    ``since`` is the version that the frames were made from. If others have published meanwhile, their parts are
    taken over; if one of them is among ``frames``, nothing is published and ``VersionConflict`` is raised.
    """
    path, base = path.rstrip("/"), _parts(spark, path.rstrip("/"), since)
    folders = {}
    for part, df in frames.items():
        folders[part] = f"data/{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{path}/{folders[part]}")
    while True:
        number = newest_version(spark, path)
        now = _parts(spark, path, number)
        lost = [p for p in frames if now.get(p) != base.get(p)]
        if lost:
            raise VersionConflict(f"version {number} has other rows of {lost} than version {since}")
        if _publish(spark, path, number + 1, {**now, **folders}):
            return number + 1


def read_version(spark: SparkSession, path: str, parts: Sequence[Part] | None = None, version: int | None = None) -> DataFrame | None:
    """All rows of a version, or of some of its parts, with the columns of all their files; None if there are none.

    The newest version is resolved once: what is published later does not change the frame.
    """
    path = path.rstrip("/")
    if version is not None and version not in _numbers(spark, path):
        raise ValueError(f"there is no version {version} of {path}")
    found = _parts(spark, path, newest_version(spark, path) if version is None else version)
    folders = sorted(f"{path}/{folder}" for part, folder in found.items() if parts is None or part in parts)
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def upsert_version(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    country: str,
    gender: str,
    tier: str,
    order: Sequence[str] = (),
    url_mapping: DataFrame | None = None,
) -> DataFrame:
    """Merge new rows into a league of a versioned table, as ``tables.upsert`` does, and publish them at once.

    Readers see the old rows until the new ones are whole. Two runs for different leagues both count; of two for one
    league the later one raises ``VersionConflict`` and can be repeated. Rows refused are returned, as there.
    """
    since = newest_version(spark, path.rstrip("/"))
    part = (country, gender, tier)
    new, refused = own_rows(new, country, gender, tier)
    stored = read_version(spark, path, [part], since) if since else None
    merged = merge_slices(stored, new, country, gender, tier, order, url_mapping)
    sort = [F.asc_nulls_first(quoted(c)) for c in merged.columns if c in SORT_CANDIDATES]
    if sort:
        merged = merged.repartitionByRange(*sort, F.xxhash64(*map(quoted, merged.columns))).sortWithinPartitions(*sort)
    replace_parts(spark, path, {part: merged}, since)
    return refused


def remove_unnamed(spark: SparkSession, path: str, keep: int = 2, hours: float = 24.0) -> int:
    """Delete data folders that none of the newest ``keep`` versions names and that are older than ``hours``.

    Older versions can no longer be read then, and writes that take longer than ``hours`` would lose their files.
    """
    path, system = path.rstrip("/"), _system(spark, path)
    numbers = _numbers(spark, path)
    named = {folder for n in numbers[-keep:] for folder in _parts(spark, path, n).values()}
    limit, removed = (time.time() - hours * 3600) * 1000, 0
    for n in numbers[:-keep]:
        system.delete(_path(spark, f"{path}/_manifest/{n:012d}"), False)
    data = _path(spark, f"{path}/data")
    for status in system.listStatus(data) if system.exists(data) else []:
        if f"data/{status.getPath().getName()}" not in named and status.getModificationTime() <= limit:
            system.delete(status.getPath(), True)
            removed += 1
    return removed
