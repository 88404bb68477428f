"""Named queries of the corpus operators over the driver tables, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.llm import decontam, hardneg, language, lm, mixing, neardup, neighbours, periodic, quality, shards, spans, tokens, toxicity
from riskledger.llm.shared import fold_remainder, read_table
from riskledger.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = fold_remainder("doc_id", 3)
    model = language.fit(docs, fold != 1)
    return language.predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == 1, F.lit(False)).alias("held_out")])


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = fresh_path(spark, "token-cache")  # a query of its own starts with an empty cache
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), cache)


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_remainder("doc_id", 7)
    return lm.lm_scores(documents(spark, sf_dir), fold == 2, fold != 2, lm.WORD_MET)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host, the language its path below it."""
    out = quality.judged(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return out.select(F.col("id").alias("doc_id"), "doc_logit", "site_share", "quality", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_table(documents(spark, sf_dir))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), every=50)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document, by the hash of its id, is made periodic first."""
    key = F.crc32(F.col("doc_id").cast("string"))
    planted = F.when(key % 10 == 0, F.floor(key / 10))
    return periodic.periodic_runs(documents(spark, sf_dir), [F.col("doc_id").cast("long").alias("doc_id")], planted)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = fold_remainder("doc_id", 4)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold != 2)
    return toxicity.predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out")])


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(read_table(spark, sf_dir, "embeddings"), 100, label)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language, op2_token_counts, op3_sentence_spans, op4_mixing, op5_lm_scores, op6_near_duplicates, op7_quality,
        op8_decontamination, op9_shards, op10_neighbours, op11_periodic_runs, op12_toxicity, op13_hard_negatives,
    )
}

ORACLE_SQL = {
    "op4_mixing": mixing.ORACLE.format(docs="documents"),
    "op13_hard_negatives": hardneg.ORACLE.format(vectors="embeddings"),
}
