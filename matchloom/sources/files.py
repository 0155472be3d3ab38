"""CSV and JSON files whose headers and names vary."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions import cast_to, quoted
from matchloom.operators.unions import relaxed_union
from matchloom.schemas import family_types
from matchloom.session import materialize

SOURCE = "source_file"

# workers need not have the package installed: its functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str = "*", recursive: bool = True):
    """Paths and lengths of files; file contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(paths).select("path", "length")


def _first_line(path: str) -> str:
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    system, local = fs.FileSystem.from_uri(path)
    with system.open_input_stream(local) as stream:
        head = b""
        while b"\n" not in head:
            chunk = stream.read(1 << 16)
            if not chunk:
                break
            head += chunk
    return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "header": [_first_line(p) for p in batch["path"]]})


def read_headers(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv") -> DataFrame:
    """The header line of each file, read in parallel and without the rest of the file."""
    files = list_files(spark, paths, glob).select("path")
    files = files.repartition(spark.sparkContext.defaultParallelism, "path")
    return files.mapInPandas(_read_headers, "path string, header string")


def catalogued_headers(spark: SparkSession, paths: str | Sequence[str], catalogue: str, glob: str = "*.csv") -> DataFrame:
    """The header line of each file, opening only files that ``catalogue`` does not know as they are now.

    The catalogue is a folder of (path, length, modificationTime, header); the listing is compared with it, what is
    missing is read and appended. A changed file has another length or time and is read again; entries of files
    that are gone stay and are not returned. A run that breaks off before its append reads the same files again.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    known = ["path", "length", "modificationTime"]
    listed = reader.load(paths).select(*known)
    schema = "path string, length bigint, modificationTime timestamp, header string"
    try:
        stored = spark.read.schema(schema).parquet(catalogue)
        new = listed.join(stored, known, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        new = listed
    new = materialize(new, "new-files")
    if not new.isEmpty():
        opened = new.select("path").repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(_read_headers, "path string, header string")
        new.join(opened, "path").select(*known, "header").write.mode("append").parquet(catalogue)
    # a file that two runs read at once stands there twice
    return listed.join(spark.read.schema(schema).parquet(catalogue).distinct(), known).select("path", "header")


def header_columns(header: str) -> list[str]:
    """Column names of a header line; a nameless column is called by its position."""
    names = next(csv.reader(io.StringIO(header)), [])
    names = [n if n else f"Unnamed: {i}" for i, n in enumerate(names)]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate columns in header: {header!r}")
    return names


def _file_path():
    """The path as it is named: Spark gives it as a URI, with some characters escaped."""
    uri = F.col("_metadata.file_path")
    return F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)


def read_csv_union(
    spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv", catalogue: str | None = None
) -> DataFrame:
    """All CSV files of a folder as one frame of strings, unified by column name.

    Spark maps the columns of a folder by position in one header, so files are
    grouped by header and each group is read with its own. ``source_file`` holds
    the path. Where all files share a header the folder is read as it is; else
    the paths of each header's files reach the driver, as they do in any listing. With a ``catalogue`` folder the
    headers of files that were read before are taken from it.
    """
    headed = read_headers(spark, paths, glob) if catalogue is None else catalogued_headers(spark, paths, catalogue, glob)
    found = materialize(headed, "headers")
    headers = [r["header"] for r in found.select("header").distinct().orderBy("header").collect()]
    filled = [h for h in headers if h]
    if not filled:
        raise FileNotFoundError(f"no files match {glob} in {paths}")

    def read(header: str, files: str | Sequence[str], **options) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header_columns(header)])
        reader = spark.read.schema(schema).options(header=True, escape='"', **options)
        return reader.csv(files).withColumn(SOURCE, _file_path())

    if len(headers) == 1:
        return read(filled[0], paths, recursiveFileLookup=True, pathGlobFilter=glob)
    groups = {
        h: [r["path"] for r in found.filter(F.col("header") == h).select("path").orderBy("path").collect()]
        for h in filled
    }
    return relaxed_union([read(h, groups[h]) for h in sorted(groups, key=groups.get)])


def type_family(df: DataFrame, family: str) -> DataFrame:
    """Cast the statistics of a family from text; dirty cells become null."""
    types = family_types(family)
    return df.select(
        *[cast_to(quoted(c), types[c]).alias(c) if c in types else quoted(c) for c in df.columns]
    )


def read_typed_csv(spark: SparkSession, paths: str | Sequence[str], family: str) -> DataFrame:
    return type_family(read_csv_union(spark, paths), family)


def name_pattern(pattern: str) -> tuple[str, list[str]]:
    """A regular expression and its fields from a pattern such as ``{Country}_{Tier}_*.csv``."""
    parts = re.split(r"\{(\w+)\}", pattern)
    regex = ""
    for i, part in enumerate(parts):
        if i % 2 == 0:
            regex += re.escape(part).replace(r"\*", "[^/]*")
            continue
        # a field that fills a whole folder or file name may hold underscores
        alone = (parts[i - 1] or "/")[-1] == "/" and (parts[i + 1] or "/")[0] in "/."
        regex += "([^/]+?)" if alone else "([^/_]+)"
    return f"(?:^|/){regex}$", parts[1::2]


def with_file_keys(df: DataFrame, pattern: str, path: str = SOURCE, observation: Observation | None = None) -> DataFrame:
    """Add the fields of a path pattern as columns; a column that exists only has its nulls filled.

    A path that does not fit the pattern gives nulls. With an ``observation`` the rows and (estimated) the paths that
    do not fit are counted while the result is computed, as ``unfit_rows`` and ``unfit_paths``.
    """
    regex, fields = name_pattern(pattern)
    if observation is not None:
        unfit = ~F.coalesce(quoted(path).rlike(regex), F.lit(False))
        paths = F.approx_count_distinct(F.when(unfit, F.coalesce(quoted(path), F.lit(""))))
        df = df.observe(observation, F.count_if(unfit).alias("unfit_rows"), paths.alias("unfit_paths"))
    derived = {
        f: F.when(quoted(path).rlike(regex), F.regexp_extract(quoted(path), regex, i + 1))
        for i, f in enumerate(fields)
    }
    return df.withColumns(
        {f: F.coalesce(quoted(f), v) if f in df.columns else v for f, v in derived.items()}
    )


def schema_inventory(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    """One row per file and column, with the keys of the file's path (such as ``stat``)."""
    outside_quotes = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    cells = F.posexplode(F.split("header", outside_quotes)).alias("position", "column")
    rows = read_headers(spark, paths).select("path", cells)
    name = F.regexp_replace("column", '^"|"$', "")
    nameless = F.concat(F.lit("Unnamed: "), F.col("position").cast("string"))
    rows = rows.withColumn("column", F.when(name == "", nameless).otherwise(name))
    return with_file_keys(rows, pattern, "path")


def schema_deviations(inventory: DataFrame, keys: Sequence[str], stat: str = "stat") -> DataFrame:
    """Columns a file has beyond its family's, other than the ``keys`` every file may carry."""
    from matchloom.schemas import FAMILIES

    declared = F.create_map(
        *[x for f in FAMILIES for x in (F.lit(f), F.array(*[F.lit(c) for c in family_types(f)]))]
    )
    allowed = F.try_element_at(declared, quoted(stat))
    known = F.coalesce(F.array_contains(allowed, F.col("column")), F.lit(False))
    return inventory.filter(~known & ~F.col("column").isin(list(keys)))


_PLAYER = "struct<player_id: bigint, player_name: string>"
LINEUP_SCHEMA = f"array<struct<team_id: bigint, team_name: string, lineup: array<{_PLAYER}>>>"
MATCH_SCHEMA = (
    "array<struct<match_id: bigint, home_score: bigint, away_score: bigint,"
    " season: struct<season_id: bigint, season_name: string>,"
    " competition: struct<competition_id: bigint, competition_name: string>>>"
)


def read_documents(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.json") -> DataFrame:
    """Whole JSON files, one per row, with the path. A file is one match or one season."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.text(paths, wholetext=True).select("value", _file_path().alias(SOURCE))


def _parsed(documents: DataFrame, schema: str) -> DataFrame:
    """Documents with their ``items``, parsed once a row.

    They come out of a generator of one row each: filters on a plain column would be moved below it, with the parser
    written out wherever they name it.
    """
    items = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    return documents.drop("items").select("*", F.explode(F.array(items)).alias("items"))


def lineup_documents(documents: DataFrame, schema: str = LINEUP_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """One row per line-up player of documents ``[home, away]``; and the bad documents.

    ``documents`` has match_id and value, from files or from a stored column.
    """
    parsed = _parsed(documents, schema)
    whole = (
        F.col("match_id").isNotNull()
        & (F.size("items") == 2)
        & F.forall("items", lambda t: t.isNotNull() & t["lineup"].isNotNull())
    )
    whole = F.coalesce(whole, F.lit(False))
    teams = parsed.filter(whole).select("match_id", F.posexplode("items").alias("side", "team"))
    players = teams.select(
        "match_id",
        F.when(F.col("side") == 0, "home").otherwise("away").alias("side"),
        F.col("team.team_id").alias("team_id"),
        F.col("team.team_name").alias("team_name"),
        F.posexplode("team.lineup").alias("position", "player"),
    ).select("match_id", "side", "team_id", "team_name", "position", "player.*")
    return players, parsed.filter(~whole).drop("items")


def match_documents(documents: DataFrame, schema: str = MATCH_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """One row per match of documents that hold arrays of matches; and the bad documents."""
    parsed = _parsed(documents, schema)
    found = parsed.filter(F.col("items").isNotNull()).select(F.explode("items").alias("m"))
    return (
        found.filter(F.col("m.match_id").isNotNull()).select("m.*"),
        parsed.filter(F.col("items").isNull()).drop("items"),
    )


def read_lineup_json(
    spark: SparkSession, paths: str | Sequence[str], schema: str = LINEUP_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Line-up files named by match id."""
    number = F.regexp_extract(SOURCE, r"(\d+)\.json$", 1).try_cast("bigint")
    return lineup_documents(read_documents(spark, paths).withColumn("match_id", number), schema)


def read_match_json(
    spark: SparkSession, paths: str | Sequence[str], schema: str = MATCH_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    return match_documents(read_documents(spark, paths), schema)
