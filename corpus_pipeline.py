"""A corpus pipeline: quality rules, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept, written
as Parquet and read again. All but the last give the columns of the documents; the last
gives a row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelstar.llm.decontamination import decontaminate
from parcelstar.llm.jaccard_join import keep_one_of_each
from parcelstar.llm.packing import op7_best_fit_packing
from parcelstar.llm.quality_rules import keep_quality
from parcelstar.llm.workers import prepare
from parcelstar.session import write_through


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, as few as possible, a row per piece."""
    prepare(spark)
    # The workers also hold what the stages before left in memory: a smaller cache.
    return op7_best_fit_packing(docs, cache=100_000)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage gives is written and read as the next one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizing is beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
