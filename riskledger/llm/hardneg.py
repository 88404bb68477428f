"""Hard negatives by rotated one-bit codes with interval filters.

Vectors of integers are turned by one random rotation; the signs of a turned vector are its code, and its alignment
(the inner product of the vector with its unit code) is stored beside it.  An anchor is cut to ``PLANES`` bits a
component, so that its inner product with a code is a few counts of common bits.  With t the anchor's product with the
code c of x, and r what x has beside its part along c, <a, x> = alignment * t + <a - t c, r>, and the last term is at
most |a - t c| |r| by Cauchy and Schwarz.  That gives every pair an interval that holds its score for certain.  Pairs
whose interval reaches what an anchor still asks for are scored in integers; no other pair can be in the result.

Anchors come in batches of bounded size, which each scan of the table takes along; a task keeps the best few of every
anchor of the batch and puts out only those.  First the positives of a batch are found, then the negatives within
their bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskledger.llm.shared import Scratch
from riskledger.workspace import fresh_path

TOP = 5
#: A negative's score is from ``LEAST`` to 100 hundredths of the positive's.
LEAST = 80
PLANES = 6
#: Bounds: anchors that a scan takes along, rows and anchors that are compared at once.
ANCHORS = 1 << 14
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 256
NEVER = np.iinfo(np.int64).min
#: Products of doubles below this are whole numbers without rounding.
EXACT = 2.0**53
INDEX = "key long, label long, v binary, code binary, alignment double, norm double"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

#: The result of the named query in SQL, for tables whose ids are distinct and whose vectors have one length.
ORACLE = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, x -> floor(256 * x::DOUBLE)) AS v
  FROM {vectors}
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM (SELECT * FROM valid WHERE vec_id % 100 = 0) a JOIN valid b ON a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, s.other AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""


def integer_rows(vectors: DataFrame, key: str, column: str, label: Column) -> DataFrame:
    """key, label, v (32-bit components floor(256 * x)) and size, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, found, size = [], [], []
            for i, values in enumerate(batch.column("v").to_pylist()):
                if not values or None in values:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    row = np.floor(256.0 * np.array(values, np.float64))
                if np.isfinite(row).all() and np.sqrt((row * row).sum()) < 2.0**31:
                    keep.append(i)
                    found.append(row.astype("<i4").tobytes())
                    size.append(len(row))
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_pydict({"key": part.column("key"), "label": part.column("label"), "v": pa.array(found, pa.binary()), "size": pa.array(size, pa.int32())})

    rows = vectors.select(F.col(key).cast("long").alias("key"), label.cast("long").alias("label"), F.col(column).alias("v"))
    return rows.filter("key IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "key long, label long, v binary, size int")


def matrix(stored: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(stored), kind).reshape(len(stored), -1)


@dataclass(frozen=True)
class Codes:
    """One rotation of vectors of ``size`` components, the same at every call."""

    size: int

    @property
    def rotation(self) -> np.ndarray:
        turn, upper = np.linalg.qr(np.random.default_rng(self.size).standard_normal((self.size, self.size)))
        return turn * np.sign(np.diag(upper))

    def packed(self, bits: np.ndarray) -> np.ndarray:
        """Rows of 0/1 as 64-bit words, the last one filled up with zeros."""
        return np.packbits(np.pad(bits, ((0, 0), (0, -self.size % 64))), axis=1).view(np.uint64)

    def encode(self, rows: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, alignments and norms."""
        turned = rows @ rotation.T
        return self.packed(turned > 0), np.abs(turned).sum(axis=1) / np.sqrt(self.size), np.sqrt((rows * rows).sum(axis=1))


def index_rows(valid: DataFrame, codes: Codes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = codes.rotation
        for batch in batches:
            if batch.num_rows:
                code, alignment, norm = codes.encode(matrix(batch.column("v").to_pylist(), "<i4").astype(np.float64), rotation)
                yield pa.RecordBatch.from_pydict({
                    **{c: batch.column(c) for c in ("key", "label", "v")},
                    "code": pa.array([c.tobytes() for c in code], pa.binary()), "alignment": pa.array(alignment), "norm": pa.array(norm),
                })

    return valid.mapInArrow(run, INDEX)


@dataclass(frozen=True)
class Rows:
    """Rows of the index, as arrays."""

    key: np.ndarray
    label: np.ndarray
    v: np.ndarray
    code: np.ndarray
    alignment: np.ndarray
    norm: np.ndarray

    @staticmethod
    def of(table: pa.RecordBatch | pa.Table) -> Rows:
        numbers = [np.asarray(table.column(c)) for c in ("key", "label", "alignment", "norm")]
        v, code = matrix(table.column("v").to_pylist(), "<i4"), matrix(table.column("code").to_pylist(), "u8")
        return Rows(numbers[0], numbers[1], v, code, numbers[2], numbers[3])

    def take(self, at) -> Rows:
        return Rows(self.key[at], self.label[at], self.v[at], self.code[at], self.alignment[at], self.norm[at])


@dataclass(frozen=True)
class Anchors:
    """A batch of anchors: their rows, and their turned components cut to ``PLANES`` bits."""

    rows: Rows
    planes: np.ndarray  # plane x anchor x word
    low: np.ndarray
    step: np.ndarray
    error: np.ndarray

    @staticmethod
    def of(rows: Rows, codes: Codes) -> Anchors:
        turned = rows.v.astype(np.float64) @ codes.rotation.T
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << PLANES) - 1), 1e-12)
        level = np.rint((turned - low) / step).astype(np.uint8)
        error = np.sqrt(np.square(turned - low - step * level).sum(axis=1))
        planes = np.stack([codes.packed(level >> b & 1) for b in range(PLANES)])
        return Anchors(rows, planes, low[:, 0], step[:, 0], error)

    def take(self, at) -> Anchors:
        return Anchors(self.rows.take(at), self.planes[:, at], self.low[at], self.step[at], self.error[at])

    def intervals(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of every anchor (row) with every one of ``rows`` (column)."""
        size = rows.v.shape[1]
        common = np.zeros((len(self.low), len(rows.key)), np.int32)
        for b, plane in enumerate(self.planes):
            held = np.bitwise_count(plane).sum(axis=1, dtype=np.int32)
            both = sum(np.bitwise_count(plane[:, None, w] & rows.code[None, :, w]).astype(np.int32) for w in range(plane.shape[1]))
            common += (2 * both - held[:, None]) << b
        signs = 2 * np.bitwise_count(rows.code).sum(axis=1, dtype=np.int32) - size
        along = (self.low[:, None] * signs + self.step[:, None] * common) / np.sqrt(size)
        slack = self.error[:, None]
        rest = np.sqrt(np.maximum(np.square(self.rows.norm)[:, None] - np.square(np.maximum(np.abs(along) - slack, 0)), 0))
        rest *= np.sqrt(np.maximum(np.square(rows.norm) - np.square(rows.alignment), 0))
        rest += slack * rows.alignment + 1e-9 * self.rows.norm[:, None] * rows.norm + 1e-6  # what rounding may change
        along *= rows.alignment
        return along - rest, along + rest

    def scores(self, rows: Rows, wanted: np.ndarray) -> np.ndarray:
        """Integer scores where ``wanted``, NEVER elsewhere."""
        out = np.full(wanted.shape, NEVER, np.int64)
        kind = np.float64 if self.rows.norm.max(initial=0) * rows.norm.max(initial=0) < EXACT else np.int64
        if wanted.mean() > 0.1:
            whole = self.rows.v.astype(kind) @ rows.v.astype(kind).T
            out[wanted] = whole[wanted]
        else:
            a, x = np.nonzero(wanted)
            for at in range(0, len(a), 1 << 15):
                to = slice(at, at + (1 << 15))
                out[a[to], x[to]] = np.einsum("ij,ij->i", self.rows.v[a[to]].astype(kind), rows.v[x[to]].astype(kind))
        return out


class Best:
    """The ``top`` highest scores of several lists with their keys, ties to smaller keys."""

    def __init__(self, lists: int, top: int):
        self.top = top
        self.score = np.full((lists, top), NEVER, np.int64)
        self.key = np.zeros((lists, top), np.int64)

    @property
    def floor(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, lists: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Offers every score of a row of ``scores`` (NEVER: none) to the list that ``lists`` names for the row."""
        if not scores.size:
            return
        floor = np.maximum(self.floor[lists], NEVER + 1)
        if scores.shape[1] > self.top:
            floor = np.maximum(floor, np.partition(scores, -self.top, axis=1)[:, -self.top])
        row, column = np.nonzero(scores >= floor[:, None])
        if not len(row):
            return
        met = np.unique(row)
        old = lists[met]
        owner = np.concatenate((lists[row], np.repeat(old, self.top)))
        score = np.concatenate((scores[row, column], self.score[old].ravel()))
        key = np.concatenate((keys[column], self.key[old].ravel()))
        order = np.lexsort((key, -score.astype(np.float64) if np.abs(score[score > NEVER]).max() < EXACT else _descending(score), owner))
        owner, score, key = owner[order], score[order], key[order]
        start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        take = (start[:, None] + np.arange(self.top)).ravel()
        self.score[owner[start]] = score[take].reshape(-1, self.top)
        self.key[owner[start]] = key[take].reshape(-1, self.top)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, key and score of all that is held."""
        lists, place = np.nonzero(self.score > NEVER)
        return lists, self.key[lists, place], self.score[lists, place]


def _descending(score: np.ndarray) -> np.ndarray:
    return ~score  # -1 - score: the other order of all 64-bit numbers


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield Rows.of(batch.slice(at, BLOCK_ROWS))


def chunks(count: int) -> Iterator[np.ndarray]:
    for at in range(0, count, BLOCK_ANCHORS):
        yield np.arange(at, min(at + BLOCK_ANCHORS, count))


def nearest_of_label(anchors: Anchors, batches: Iterator[pa.RecordBatch], top: int) -> Best:
    """For each anchor the highest scoring other rows of its label."""
    best = Best(len(anchors.low), top)
    for block in blocks(batches):
        for label in np.intersect1d(anchors.rows.label, block.label):
            rows = block.take(block.label == label)
            own = np.flatnonzero(anchors.rows.label == label)
            for part in (own[c] for c in chunks(len(own))):
                some = anchors.take(part)
                wanted = some.intervals(rows)[1] >= best.floor[part][:, None]
                wanted &= some.rows.key[:, None] != rows.key
                best.add(part, some.scores(rows, wanted), rows.key)
    return best


def nearest_within(anchors: Anchors, positive: np.ndarray, batches: Iterator[pa.RecordBatch], top: int, least: int) -> Best:
    """For each anchor and each of its positives (scores, NEVER for none) the best rows of other labels within bounds."""
    each = positive.shape[1]
    best = Best(positive.size, top)
    real = positive > NEVER
    hundreds, rest = np.divmod(np.maximum(positive, 0), 100)  # the product with ``least`` may not fit a long
    low = np.where(real & (positive >= 0), least * hundreds - (-least * rest // 100), np.iinfo(np.int64).max)
    for block in blocks(batches):
        for part in chunks(len(positive)):
            some = anchors.take(part)
            lists = part[:, None] * each + np.arange(each)
            floor = np.maximum(low[part], best.floor[lists])
            below, above = some.intervals(block)
            wanted = (above >= floor.min(axis=1)[:, None]) & (below <= positive[part].max(axis=1)[:, None])
            wanted &= some.rows.label[:, None] != block.label
            scores = some.scores(block, wanted)
            for j in range(each):
                inside = (scores >= floor[:, j, None]) & (scores <= positive[part, j, None])
                best.add(lists[:, j], np.where(inside, scores, NEVER), block.key)
    return best


def top_of(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Adds ``place`` (from 1): the ``top`` highest scores of each group, ties to smaller keys."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "key")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def hard_negatives(
    vectors: DataFrame, every: int, label: Column, key: str = "vec_id", column: str = "embedding", top: int = TOP, least: int = LEAST, batch: int = ANCHORS,
) -> DataFrame:
    """The hardest negatives of each positive of each anchor: ``RESULT``, ranks from 1.

    Scores are inner products of the components floor(256 * x).  Anchors are the rows whose key is divisible by
    ``every``.  An anchor's positives are its ``top`` highest scoring other rows of its label; a positive's negatives
    are the ``top`` highest scoring rows of other labels with ``least`` to 100 hundredths of its score.  Ties go to
    smaller keys.  A positive without such a row has no row in the result.

    Rows without a key, label or vector, or with a null or non-finite component, take no part; nor do vectors of
    another length than most (ties: the shorter), empty ones, or those of a length of 2**31 or more in integers, whose
    scores a long may not hold.  Rows that repeat key, label and vector count as one; of unlike rows with one key the
    one of the smallest label, then vector counts.  An empty table gives an empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    with Scratch(spark, "hard-negatives") as scratch:
        valid = scratch.stage(integer_rows(vectors, key, column, label), "rows")
        sizes = valid.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
        if not sizes:
            return spark.createDataFrame([], RESULT)
        size, n = sizes[0]["size"], sizes[0]["count"]
        parts = max(-(-n // 65_536), min(64, -(-n // BLOCK_ROWS)))
        one = valid.filter(F.col("size") == size).repartition(parts, "key").groupBy("key").agg(F.min(F.struct("label", "v")).alias("row"))
        codes = Codes(size)
        index = scratch.stage(index_rows(one.select("key", "row.label", "row.v"), codes), "index")
        asking = index.filter(F.col("key") % every == 0)
        batches = max(-(-asking.count() // batch), 1)
        number = F.pmod(F.xxhash64("key"), F.lit(batches))
        positives, negatives = fresh_path(spark, "hard-negatives-positives"), fresh_path(spark, "hard-negatives-negatives")
        for i in range(batches):
            table = asking.filter(number == i).orderBy("key").toArrow()  # about ``batch`` rows
            if table.num_rows:
                mine(spark, index, Anchors.of(Rows.of(table), codes), top, least, f"{positives}/batch={i}", f"{negatives}/batch={i}")
        if not asking.head(1):
            return spark.createDataFrame([], RESULT)
        near = spark.read.parquet(positives).select("anchor_id", F.col("place").alias("positive"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
        hard = spark.read.parquet(negatives).select("anchor_id", "positive", F.col("place").alias("rank"), F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
        return hard.join(near, ["anchor_id", "positive"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(spark: SparkSession, index: DataFrame, anchors: Anchors, top: int, least: int, positives: str, negatives: str) -> None:
    """Writes the positives (anchor_id, key, score, place) and negatives (and the place of their positive) of a batch."""
    held = spark.sparkContext.broadcast(anchors)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, key, score = nearest_of_label(held.value, batches, top).found()
        yield pa.RecordBatch.from_pydict({"anchor_id": pa.array(held.value.rows.key[lists]), "key": pa.array(key), "score": pa.array(score)})

    found = index.mapInArrow(near, "anchor_id long, key long, score long")
    top_of(found, ["anchor_id"], top).write.parquet(positives)
    rows = spark.read.parquet(positives).toArrow()  # ``top`` for each anchor of the batch
    score = np.full((len(anchors.low), top), NEVER, np.int64)
    if rows.num_rows:
        at = np.searchsorted(anchors.rows.key, np.asarray(rows.column("anchor_id")))
        score[at, np.asarray(rows.column("place")) - 1] = np.asarray(rows.column("score"))
    bounds = spark.sparkContext.broadcast(score)

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, key, score = nearest_within(held.value, bounds.value, batches, top, least).found()
        yield pa.RecordBatch.from_pydict({
            "anchor_id": pa.array(held.value.rows.key[lists // top]), "positive": pa.array((lists % top + 1).astype(np.int32)), "key": pa.array(key), "score": pa.array(score),
        })

    found = index.mapInArrow(hard, "anchor_id long, positive int, key long, score long")
    top_of(found, ["anchor_id", "positive"], top).write.parquet(negatives)
    held.unpersist()
    bounds.unpersist()
