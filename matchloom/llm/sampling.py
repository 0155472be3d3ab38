"""A bounded sample of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import text_or_empty


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` ids for each of the labels 0 and 1, chosen by a hash of the id.

    A table that holds no more is taken whole. Labels of null or repeated ids: a null id is left out, and of
    an id's several labels the largest counts. Of an id's several texts or repeated rows one text counts, the one
    with the least hash, so 2 * per_class rows at most are collected. Only the chosen ids are joined with the texts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    single = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    picked = None
    for value in (0, 1):
        part = single.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionAll(part)
    # 2 * per_class rows of two numbers
    chosen = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("o")
    rows = chosen.groupBy("doc_id", "label").agg(one).select("doc_id", "o.text", "label").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return list(zip(rows["text"].to_pylist(), rows["label"].to_pylist(), strict=True))


def prior(labels: DataFrame, label: str) -> float:
    """The share of label 1 among all labelled rows; one half without any."""
    n, ones = labels.where(F.col(label).isin(0, 1)).agg(F.count(F.lit(1)), F.sum(label)).first()
    return min(max(ones / n, 1e-4), 1 - 1e-4) if n else 0.5
