"""Columns and helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the white space of the word pattern [^\x20\x09-\x0D]+, beside the blank itself
OTHER_SPACE = "\t\n\x0b\f\r"
NO_ID = -(2**63)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bind(value: Column, function) -> Column:
    """``function`` of a value that is computed once, though lambdas in it name it again and again.

    A plain column would be written out wherever it is named once the optimiser moves a filter below it.
    """
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Plain replacement passes over bytes; one translation by a table of characters is ten times slower."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def words(text: Column) -> Column:
    """The array of words ``[^\\x20\\x09-\\x0D]+``; a split at one blank needs no regular expression."""
    return F.array_remove(F.split(_replaced(text, OTHER_SPACE, " "), " "), "")


def without_space(text: Column) -> Column:
    return _replaced(text, " " + OTHER_SPACE, "")


def count_of(text: Column, characters: str) -> Column:
    """How many of these characters the text has."""
    return F.length(text) - F.length(_replaced(text, characters, ""))


def has_word(text: Column) -> Column:
    return F.btrim(text, F.lit(" " + OTHER_SPACE)) != ""


def with_row_key(docs: DataFrame, text: Column) -> DataFrame:
    """Add ``kd`` and ``k1``, which are never null: rows of one id and one text share them."""
    return docs.withColumns({"kd": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "k1": F.xxhash64(text)})


def pieces_of(batches, column: int, most: int = 2_000_000) -> Iterator:
    """Slices of Arrow batches that hold about ``most`` bytes of the string column, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        ends, start, n = np.cumsum(sizes), 0, batch.num_rows
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


# tables of at most this many rows of a few numbers are broadcast; larger ones are joined by shuffling
MAX_BROADCAST_ROWS = 1_000_000


# folders written inside of each open scratch, the innermost last
_scratches: ContextVar[tuple[list, ...]] = ContextVar("scratches", default=())


@contextmanager
def scratch() -> Iterator[None]:
    """Tables staged inside are deleted at the end, also after a failure, but for those staged with ``keep``.

    Nothing that is returned from inside may read the others.
    """
    folders: list = []
    token = _scratches.set((*_scratches.get(), folders))
    try:
        yield
    finally:
        _scratches.reset(token)
        for spark, path in folders:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str, keep: bool = False, hashes: bool = False) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back; its shuffle files go when it is written.

    With ``keep`` it outlives the innermost scratch. A table of ``hashes``, which hardly repeat, is written
    without dictionaries.
    """
    from matchloom.session import work_folder

    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    path = work_folder(spark, label)
    owners = _scratches.get()[:-1] if keep else _scratches.get()
    if owners:
        owners[-1].append((spark, path))
    spark.conf.set(key, "true")
    try:
        df.write.options(**{"compression": "zstd", "parquet.enable.dictionary": str(not hashes).lower()}).parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def small(staged: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if its counted rows are few."""
    return F.broadcast(staged) if staged.count() <= MAX_BROADCAST_ROWS else staged
