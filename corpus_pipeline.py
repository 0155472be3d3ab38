"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import decontamination, line_dedup, packing, quality_rules, simhash_dedup
from matchloom.llm.common import stage
from matchloom.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents, without the lines that break a rule."""
    return quality_rules.clean_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that resemble an earlier one."""
    return line_dedup.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.near_dedup(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), added_tokens=True)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

# the near-duplicate and packing stages cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each stage returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
