"""From collected documents to packed training sequences, stage by stage.

Each stage takes what the one before it kept, written as Parquet, and calls one of
the operators in ``pagetables.llm``.

Documents without a text, without an id or that come twice go the way the stages'
operators define; an empty table comes out as no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import decontam, line_dedup, near_dedup, packing, quality_rules
from pagetables.llm.queries import tokenizer_file
from pagetables.session import materialize
from pagetables.sources.tables import table


def counted(docs: DataFrame) -> DataFrame:
    """The count of characters is that of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, and documents that lose too much or fail as a whole."""
    return counted(quality_rules.clean(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; documents stay."""
    return counted(line_dedup.clean(docs, host="source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.clean(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    return packing.pack(docs, tokenizer_file())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("packing", sequences),
]

#: Near duplicates, alignment and tokenizers are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
