"""Token counts of whole texts with a cache of counts by content digest.

Texts are never counted twice: the SHA-256 of the (normalised) content and the digest of the
tokenizer's file look up stored counts; one text of every digest that is missing is encoded and its
count appended to the cache.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import path_exists, pieces

CACHE = "digest binary, version string, n_tokens long"


def whole_text(text: Column) -> Column:
    """Default normalisation: null is the empty text; nothing else keeps every count of every tokenizer."""
    return F.coalesce(text, F.lit(""))


def version_of(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of texts, without begin, end or other added tokens, truncation or padding."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def stored_counts(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Digest and count of one tokenizer version; repeated appends of a digest count once."""
    spark = docs.sparkSession
    stored = spark.read.schema(CACHE).parquet(cache) if path_exists(spark, cache) else spark.createDataFrame([], CACHE)
    stored = stored.filter(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024, content: Callable[[Column], Column] = whole_text
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    ``tokenizer`` is a file every executor can read, ``cache`` a Parquet folder in a shared store.
    Null texts are empty: no bytes, no tokens.  Repeated rows and ids keep one result row each.
    """
    version = version_of(tokenizer)
    text = content(F.col("text"))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(tokenizer)
        for batch in batches:
            for part in pieces(batch, "content", limit=1 << 20, rows=256):
                n = count(part.column("content").to_pylist())
                yield pa.RecordBatch.from_pydict({"digest": part.column("digest"), "n_tokens": pa.array(n, pa.int64())})

    # Copies are merged before the shuffle, so a text of a third of all rows moves once per task.
    distinct = docs.select(digest.alias("digest"), text.alias("content")).groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(stored_counts(docs, cache, version), "digest", "left_anti")
    counted = misses.mapInArrow(encode, "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)

    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), digest.alias("digest"))
    known = rows.join(stored_counts(docs, cache, version), "digest")
    return known.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
