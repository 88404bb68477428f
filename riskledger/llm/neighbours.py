"""Approximate nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on a bounded sample and every vector is put into a leaf.  A query walks the tree best bin
first: a priority queue holds the branches not taken, nearest centre first.  How many leaves a query visits is
calibrated: leaf visits widen until the neighbours that brute force finds for a sample of queries are reached.
The tree has about ``LEAVES`` leaves at any size, so the visits of a query do not grow with the table.  They come in
two rounds: the first leaves give each query a floor, and later leaves put out only what reaches it.
Equal vectors are one class; only as many of their ids as a result can show are carried on.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger.llm.shared import Scratch

TOP = 5
BRANCHES = 8
#: Bounds: vectors that the tree is fitted on, queries of the calibration.
SAMPLE = 20_000
CALIBRATED = 256
#: A node of the tree is split while it holds more than this share of the sample.
LEAVES = 256
TARGET = 0.97
BLOCK = 4096
#: No cosine is below; and what rounding may change between two blocks.
NO_FLOOR, SLACK = -2.0, 1e-9


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """key and the vector's bytes, of vectors that take part: finite, not zero, of the most common length, with an id."""
    kind = vectors.schema[column].dataType.elementType
    code = "<f4" if isinstance(kind, T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found, size = [], [], []
            for name, values in zip(batch.column("key").to_pylist(), batch.column("v").to_pylist()):
                if values is None or name is None or not values or None in values:
                    continue
                row = np.array(values, code)
                length = np.linalg.norm(row.astype(np.float64))
                if np.isfinite(row).all() and 0 < length < np.inf:
                    keys.append(name)
                    found.append((row + np.array(0, code)).tobytes())  # one zero
                    size.append(len(row))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "v": pa.array(found, pa.binary()), "size": pa.array(size, pa.int32())})

    return vectors.select(F.col(key).cast("long").alias("key"), F.col(column).alias("v")).mapInArrow(run, "key long, v binary, size int")


@dataclass(frozen=True)
class Rows:
    """Turns stored bytes into unit vectors of doubles."""

    code: str
    size: int

    def unit(self, stored: list[bytes]) -> np.ndarray:
        rows = np.frombuffer(b"".join(stored), self.code).reshape(-1, self.size).astype(np.float64)
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass(frozen=True)
class Tree:
    centres: list[np.ndarray]  # of the children of each inner node
    children: list[list[int]]  # inner nodes as their numbers, leaf i as -1 - i
    leaves: int

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), -1, np.int64)
        todo = [(0, np.arange(len(rows)))] if self.centres else []
        while todo:
            node, index = todo.pop()
            nearest = (rows[index] @ self.centres[node].T).argmax(axis=1)
            for k, child in enumerate(self.children[node]):
                part = index[nearest == k]
                if child < 0:
                    out[part] = -1 - child
                elif len(part):
                    todo.append((child, part))
        return np.maximum(out, 0)

    def best_first(self, row: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in the order of their centres' nearness, branches kept in a priority queue."""
        if not self.centres:
            return [0]
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                continue
            for near, child in zip(self.centres[node] @ row, self.children[node]):
                heapq.heappush(queue, (-float(near), child))
        return out


def grow(sample: np.ndarray, leaf: float, seed: int = 5) -> Tree:
    """Splits the sample by spherical k-means until nodes hold ``leaf`` rows of it at most."""
    random = np.random.default_rng(seed)
    centres: list[np.ndarray] = []
    children: list[list[int]] = []
    leaves = 0

    def split(rows: np.ndarray, depth: int) -> int:
        nonlocal leaves
        if len(rows) > max(leaf, 1) and len(rows) > 1 and depth < 24:
            centre = rows[np.sort(random.choice(len(rows), min(BRANCHES, len(rows)), replace=False))]
            for _ in range(12):
                label = (rows @ centre.T).argmax(axis=1)
                sums = np.stack([rows[label == k].sum(axis=0) for k in range(len(centre))])
                length = np.linalg.norm(sums, axis=1, keepdims=True)
                centre = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centre)
            label = (rows @ centre.T).argmax(axis=1)
            used = np.unique(label)
            if len(used) > 1:
                node = len(centres)
                centres.append(centre[used])
                children.append([])
                children[node] = [split(rows[label == k], depth + 1) for k in used]
                return node
        leaves += 1
        return -leaves

    split(sample, 0)
    return Tree(centres, children, max(leaves, 1))


def best_of(scores: np.ndarray, ids: list[list[int]], most: int, floor: float) -> list[tuple[float, int]]:
    """The ``most`` nearest ids of one query with a score of ``floor`` at least, ties to smaller ids."""
    if len(scores) > most:
        floor = max(floor, np.partition(scores, -most)[-most])
    keep = np.flatnonzero(scores >= floor)
    return [(-s, i) for s, i in sorted((-float(scores[k]), i) for k in keep for i in ids[k])[:most]]


def top_of(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of every query, ties to smaller ids."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most).select("q", "vec_id", "score")


def visited(index: DataFrame, asking: DataFrame, rows: Rows, most: int, scratch: Scratch) -> DataFrame:
    """q, vec_id and score of the ``most`` nearest of each query in each leaf that it visits, if they reach its floor.

    Blocks of a leaf meet blocks of its visitors, so that no group grows with the data.
    """
    parts = index.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sides = asking.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("sides"))
    plan = F.broadcast(scratch.stage(parts.join(sides, "leaf"), "plan"))  # a row per leaf
    held = index.join(plan, "leaf").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    held = held.withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    asking = asking.join(plan, "leaf").withColumn("side", F.pmod(F.xxhash64("q"), F.col("sides")).cast("int"))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, data = left.column("ids").to_pylist(), rows.unit(left.column("v").to_pylist())
            names, asks = right.column("q").to_pylist(), rows.unit(right.column("qv").to_pylist())
            floors = np.asarray(right.column("floor"))
            for at in range(0, len(names), 256):
                scores = asks[at : at + 256] @ data.T
                open_ = np.flatnonzero(scores.max(axis=1) >= floors[at : at + 256])
                out += [(names[at + k], i, s) for k in open_ for s, i in best_of(scores[k], ids, most, floors[at + k])]
        return pa.table({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate((("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())))})

    keys = ("leaf", "block", "side")
    pairs = held.select(*keys, "ids", "v").groupBy(*keys).cogroup(asking.select(*keys, "q", "qv", "floor").groupBy(*keys))
    return pairs.applyInArrow(compare, "q long, vec_id long, score double")


def nearest(vectors: DataFrame, every: int, key: str = "vec_id", column: str = "embedding", top: int = TOP, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id and score: the ``top`` nearest found of every vector whose key is divisible by ``every``.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do vectors without an id or
    of another length than most.  Rows that repeat an id and a vector count as one.
    """
    spark = vectors.sparkSession
    with Scratch(spark, "nearest") as scratch:
        result = "query_id long, rank int, vec_id long, score double"
        valid = scratch.stage(usable(vectors, key, column), "vectors")
        sizes = valid.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
        if not sizes:
            return spark.createDataFrame([], result)
        kind = vectors.schema[column].dataType.elementType
        rows = Rows("<f4" if isinstance(kind, T.FloatType) else "<f8", sizes[0]["size"])
        valid = valid.filter(F.col("size") == rows.size).select("key", "v").distinct()

        # Classes of equal vectors with their smallest ids; the limit is applied before the shuffle.
        rank = F.row_number().over(Window.partitionBy("v").orderBy("key"))
        classes = valid.withColumn("n", rank).filter(F.col("n") <= top + 1)
        classes = classes.groupBy("v").agg(F.array_sort(F.collect_list("key")).alias("ids"))
        classes = scratch.stage(classes.select(F.col("ids")[0].alias("cls"), "ids", "v"), "classes")
        n = max(classes.count(), 1)

        share = F.pmod(F.xxhash64("cls", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
        sample = classes.filter(share < min(1.0, 1.2 * SAMPLE / n)).orderBy(F.xxhash64("cls", F.lit(9))).limit(SAMPLE).select("v").collect()
        fitted = rows.unit([bytes(r["v"]) for r in sample]) if sample else np.zeros((0, rows.size))
        tree = spark.sparkContext.broadcast(grow(fitted, len(fitted) / LEAVES))  # its size hangs on LEAVES alone

        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    found = tree.value.leaf_of(rows.unit(batch.column("v").to_pylist()))
                    yield pa.RecordBatch.from_pydict({"leaf": pa.array(found), **{c: batch.column(c) for c in ("cls", "ids", "v")}})

        index = scratch.stage(classes.mapInArrow(put, "leaf long, cls long, ids array<long>, v binary"), "index")
        asked = valid.filter(F.col("key") % every == 0).join(classes.select("v", "cls"), "v").select(F.col("key").alias("query_id"), "cls")
        asked = scratch.stage(asked, "asked", keep=True)
        searching = scratch.stage(classes.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "v"), "searching")
        visits = calibrate(searching, index, rows, tree, top, target)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    leaves = [tree.value.best_first(r, visits) for r in rows.unit(part.column("v").to_pylist())]
                    take = pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in leaves]))
                    place = np.concatenate([np.arange(len(x), dtype=np.int32) for x in leaves])
                    yield pa.RecordBatch.from_pydict({
                        "leaf": pa.array(np.concatenate(leaves)), "place": pa.array(place), "q": part.column("cls").take(take), "qv": part.column("v").take(take),
                    })

        walked = scratch.stage(searching.mapInArrow(walk, "leaf long, place int, q long, qv binary"), "visits")
        # The floor is the least of the nearest in the first leaves; about the square root of all visits makes both rounds put out alike.
        first = math.isqrt(visits)
        early = walked.filter(F.col("place") < first).select("leaf", "q", "qv", F.lit(NO_FLOOR).alias("floor"))
        found = scratch.stage(top_of(visited(index, early, rows, top + 1, scratch), top + 1), "early")
        full = found.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == top + 1)
        late = walked.filter(F.col("place") >= first).join(full, "q", "left")
        late = late.select("leaf", "q", "qv", F.coalesce(F.col("least") - SLACK, F.lit(NO_FLOOR)).alias("floor"))
        found = top_of(found.unionByName(visited(index, late, rows, top + 1, scratch)), top + 1)
        found = scratch.stage(found, "found", keep=True)
        own = asked.distinct().join(found, F.col("cls") == F.col("q")).filter("vec_id != query_id")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return own.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def calibrate(searching: DataFrame, index: DataFrame, rows: Rows, tree, top: int, target: float) -> int:
    """How many leaves a query must visit for ``target`` of the true neighbours of a sample of queries.

    The sample is bounded; its neighbours are found by brute force over all vectors, a few candidates per batch.
    """
    sample = searching.orderBy(F.xxhash64("cls", F.lit(4))).limit(CALIBRATED).collect()
    if not sample:
        return 1
    names = [r["cls"] for r in sample]
    asks = index.sparkSession.sparkContext.broadcast(rows.unit([bytes(r["v"]) for r in sample]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                scores = asks.value @ rows.unit(part.column("v").to_pylist()).T
                most = min(top + 1, part.num_rows)
                best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                query = np.repeat(np.arange(len(scores)), most)
                pick = pa.array(best.ravel())
                yield pa.RecordBatch.from_pydict({
                    "q": pa.array(query), "score": pa.array(np.take_along_axis(scores, best, 1).ravel()), "leaf": part.column("leaf").take(pick), "cls": part.column("cls").take(pick),
                })

    found = index.select("leaf", "cls", "v").mapInArrow(scan, "q long, score double, leaf long, cls long")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))
    true = found.withColumn("n", order).filter(F.col("n") <= top + 1).collect()
    place = [{leaf: i for i, leaf in enumerate(tree.value.best_first(row, tree.value.leaves))} for row in asks.value]
    need = np.sort([place[r["q"]][r["leaf"]] + 1 for r in true if r["cls"] != names[r["q"]]])
    visits = 1
    while visits < tree.value.leaves and len(need) and np.searchsorted(need, visits, "right") < target * len(need):
        visits += max(1, visits // 8)
    return min(visits, tree.value.leaves)
