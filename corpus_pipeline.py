"""From raw documents to shards: quality, near duplicates, benchmark passages, source mix, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.llm import decontam, mixing, neardup, quality, shards
from riskledger.llm.shared import Scratch, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; their source is the host, their language the path."""
    judged = quality.judged(docs, read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return judged.filter("kept").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return shards.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: SQL states neither the classifier nor the signatures; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again."""
    with Scratch(spark, "pipeline") as scratch:
        docs = read_table(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            docs = scratch.stage(stage(spark, docs, sf_dir), name)
        last, stage = STAGES[-1]
        return scratch.stage(stage(spark, docs, sf_dir), last, keep=True)
