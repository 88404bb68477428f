"""Sharding by sampled splitters: shards of nearly equal bytes, equal texts next to each other.

Rows are ordered by a place: the hash of the text, then that of the id, so that equal texts follow each other
and a group of copies of any size can still be cut.  A size-weighted sample of places gives the quantiles that
cut the order into ranges; ranges that turn out overfull are cut again.  Exact sums per range and running sums
inside it place every row in the whole order of bytes, which is cut into equal shards.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.llm.shared import Scratch
from riskledger.workspace import partition_count

LAW = "bytes"
SHARDS = 8
#: Draws per range, rows that a range should have at most, and the bound on ranges (and so on splitters).
DRAWS = 64
RANGE_ROWS = 2_000_000
MOST_RANGES = 1 << 16
#: A range with so many times its share is cut again.
OVERFULL = 4
_LOW = 0xFFFFFF


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def place_of(text: Column, key: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.xxhash64(key).bitwiseAND(F.lit(_LOW)))


def range_of(splitters: np.ndarray) -> Callable[[Column], Column]:
    @F.arrow_udf("int")
    def number(place: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(splitters, np.asarray(place), "right").astype(np.int32))

    return number


def draw_places(rows: DataFrame, rate: float, extra: float, seed: int) -> list[tuple[int, int]]:
    """Places with their numbers of draws, ``rate`` per byte; every row counts as ``extra`` bytes more."""
    wanted = (F.col("size") + extra) * rate
    chance = F.pmod(F.xxhash64("place", "doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    draws = (F.floor(wanted) + F.when(chance < wanted - F.floor(wanted), 1).otherwise(0)).cast("long")
    found = rows.select("place", draws.alias("draws")).filter("draws > 0").groupBy("place").agg(F.sum("draws").alias("draws"))
    return sorted((r["place"], r["draws"]) for r in found.collect())


def quantiles(sample: list[tuple[int, int]], parts: int) -> np.ndarray:
    """``parts - 1`` places at equal weights of the sample."""
    if not sample or parts < 2:
        return np.zeros(0, np.int64)
    place = np.array([p for p, _ in sample], np.int64)
    weight = np.cumsum([w for _, w in sample])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return np.unique(place[np.minimum(at, len(place) - 1)])


def splitters_of(rows: DataFrame, ranges: int) -> tuple[np.ndarray, list]:
    """Splitters, and rows and bytes per range, with no range over ``OVERFULL`` shares if places can part it."""
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n, size = total["n"], total["bytes"] or 0
    mean = size / max(n, 1)  # half of the weight goes by rows, half by bytes
    sample = draw_places(rows, DRAWS * ranges / max(2.0 * size, 1.0), mean, 1)
    cuts = quantiles(sample, ranges)
    for attempt in range(8):
        counted = rows.groupBy(range_of(cuts)(F.col("place")).alias("range"))
        sums = counted.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("place").alias("low"), F.max("place").alias("high")).collect()
        share_n, share_b = OVERFULL * n / ranges, OVERFULL * size / ranges
        over = [r for r in sums if (r["n"] > share_n or r["bytes"] > share_b) and r["low"] < r["high"]]
        if not over or attempt == 7:
            break
        hot = rows.withColumn("range", range_of(cuts)(F.col("place"))).filter(F.col("range").isin([r["range"] for r in over]))
        more = [np.zeros(0, np.int64)]
        again = draw_places(hot, 4 * DRAWS * ranges / max(2.0 * size, 1.0), mean, 2 + attempt)
        for r in over:
            inside = [(p, w) for p, w in again if r["low"] < p <= r["high"]]
            more.append(quantiles(inside, 2 * int(np.ceil(max(r["n"] / share_n, r["bytes"] / share_b))) + 1))
        wider = np.unique(np.concatenate((cuts, *more)))
        if len(wider) == len(cuts):
            break
        cuts = wider
    return cuts, sorted(sums, key=lambda r: r["range"])


def positioned(rows: DataFrame, cuts: np.ndarray, sums: list) -> DataFrame:
    """Adds row_at and byte_at, the number of rows and bytes before each row in the whole order."""
    spark = rows.sparkSession
    offsets, row_at, byte_at = [], 0, 0
    for r in sums:
        offsets.append((r["range"], row_at, byte_at))
        row_at, byte_at = row_at + r["n"], byte_at + r["bytes"]
    table = spark.createDataFrame(offsets, "_range int, _rows long, _bytes long")
    order = Window.partitionBy("range").orderBy("place", F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    inside = rows.withColumn("range", range_of(cuts)(F.col("place"))).withColumn("_n", F.row_number().over(order))
    inside = inside.withColumn("_sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # One row per range, MOST_RANGES (plus cuts of overfull ones) at most.
    placed = inside.join(F.broadcast(table), F.col("range") == F.col("_range"))
    placed = placed.withColumn("row_at", F.col("_rows") + F.col("_n") - 1).withColumn("byte_at", F.col("_bytes") + F.col("_sum") - F.col("size"))
    return placed.drop("range", "_range", "_rows", "_bytes", "_n", "_sum")


def sharded(docs: DataFrame, shards: int, whole: bool, scratch: Scratch) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``; with ``whole``, the row as a struct too."""
    text, key = F.col("text"), F.col("doc_id")
    columns = [key.cast("long").alias("doc_id"), size_of(text).alias("size"), checksum(text).alias("text_crc32"), place_of(text, key).alias("place")]
    narrow = scratch.stage(docs.select(*columns), "sizes", keep=True)
    n = narrow.count()
    ranges = int(min(MOST_RANGES, max(4 * shards, partition_count(docs.sparkSession), -(-n // RANGE_ROWS))))
    cuts, sums = splitters_of(narrow, ranges)
    total = sum(r["bytes"] for r in sums) or 1
    shard = F.least(F.expr(f"byte_at * {shards} div {total}"), F.lit(shards - 1)).cast("int")
    placed = positioned(narrow, cuts, sums).withColumn("shard", shard)
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("row_at").alias("first")).collect()}
    if whole:
        placed = positioned(docs.select(F.struct("*").alias("row"), *columns), cuts, sums).withColumn("shard", shard)
    start = F.element_at(F.array(*[F.lit(first.get(s, 0)).cast("long") for s in range(shards)]), F.col("shard") + 1)
    return placed.withColumn("slot", F.col("row_at") - start).drop("place", "row_at", "byte_at")


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null) of every row of ``docs`` (doc_id, text).

    Shards hold nearly equal bytes: each differs from its share by one document at most.  Null texts have size 1 and
    the checksum of the empty text.  Null ids and repeated rows are rows like all others.
    """
    with Scratch(docs.sparkSession, "shards") as scratch:
        out = sharded(docs, shards, False, scratch)
        law, grown = F.lit(LAW).alias("law"), F.lit(None).cast("int").alias("grown_shard")
        return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with all their columns, and their shard and slot (columns of these names are replaced)."""
    with Scratch(docs.sparkSession, "shards") as scratch:
        out = sharded(docs, shards, True, scratch)
        keep = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
        return out.select(*keep, "shard", "slot")
