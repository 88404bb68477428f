"""Near duplicates on word shingles by MinHash signatures and a multi-index Hamming join.

A text is the set of its distinct five-word shingles.  Its signature has ``CHUNKS`` chunks of ``WIDTH``
MinHash values of 16 bits.  If two signatures differ in fewer than ``CHUNKS * (ERRORS + 1)`` values, some
chunk differs in at most ``ERRORS`` = 1 values (pigeonhole), so both have the same key for that chunk
with one value left out: these keys are enumerated and joined.  Texts at the threshold meet in one chunk
with probability 0.74, in none of ten with 1.5e-6.  Pairs whose signatures differ in more than ``FAR``
values (probability 2e-8 at the threshold) are left; all others are confirmed on whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.graph import components
from riskledger.llm.shared import Prefixes, Scratch, as_bytes, folded_words, mix, pieces, word_bounds

WORDS = 5
PERCENT = 75
CHUNKS, WIDTH, ERRORS = 10, 4, 1
HASHES = CHUNKS * WIDTH
FAR = 26
#: Members of a bucket that one task compares with each other at most.
BLOCK = 4096
#: Rows of a batch that goes to Python; a row of a pair has two whole texts.
BATCH_ROWS = 1000

_steps = np.random.Generator(np.random.PCG64(7))
_FACTORS = _steps.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _steps.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; shorter texts are one shingle, empty ones none."""
    line = folded_words(text)
    start, end = word_bounds(line)
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    last = max(len(start) - WORDS + 1, 1)
    return np.unique(Prefixes(line).spans(start[:last], end[-last:]))


def signature(items: np.ndarray) -> np.ndarray:
    """The 16-bit MinHash values of a non-empty set."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(low), 2048):
            values = low[None, at : at + 2048] * _FACTORS[:, None]
            values += _SHIFTS[:, None]
            np.minimum(least, values.min(axis=1), out=least)
    return (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint (f1, f2) of the set and its signature (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sizes, first, second, signs = [], [], [], []
                for text in as_bytes(part.column("text")):
                    items = shingles(text)
                    sizes.append(len(items))
                    with np.errstate(over="ignore"):
                        first.append(int(np.sum(items, dtype=np.uint64).view(np.int64)))
                        second.append(int(np.sum(mix(items ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64).view(np.int64)))
                    signs.append(signature(items).tobytes() if len(items) else None)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()), "f1": pa.array(first, pa.int64()),
                    "f2": pa.array(second, pa.int64()), "signature": pa.array(signs, pa.binary()),
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, signature binary")


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """The keys of each signature: every chunk with each one of its values left out."""
    keys = np.empty((len(signs), CHUNKS, WIDTH), np.uint64)
    chunks = signs.reshape(len(signs), CHUNKS, WIDTH).astype(np.uint64)
    for left in range(WIDTH):
        kept = [i for i in range(WIDTH) if i != left]
        value = np.zeros((len(signs), CHUNKS), np.uint64)
        for i in kept:
            value = (value << np.uint64(16)) | chunks[:, :, i]
        tag = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left + 1)
        keys[:, :, left] = mix(value ^ mix(tag)[None, :])
    return keys.reshape(len(signs), HASHES).view(np.int64)


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def keyed(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = chunk_keys(_signs(part.column("signature")))
                node = np.repeat(np.asarray(part.column("node")), HASHES)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel()), "node": pa.array(node)})

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def near(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Pairs that the signatures and the set sizes leave open."""
    open_sizes = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return open_sizes & ((a != b).sum(axis=-1) <= FAR)


def near_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) under the signature distance."""
    for side in ("a", "b"):
        other = nodes.select(F.col("node").alias(side), F.col("signature").alias(f"s{side}"), F.col("n_shingles").alias(f"n{side}"))
        pairs = pairs.join(other, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = near(*[_signs(batch.column(c)) for c in ("sa", "sb")], *[np.asarray(batch.column(c)) for c in ("na", "nb")])
                yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(pa.array(keep)) for c in ("a", "b")})

    return pairs.mapInArrow(run, "a long, b long").distinct()


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole shingle sets reach the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"t{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "tb"):
                keep = []
                for left, right in zip(as_bytes(part.column("ta")), as_bytes(part.column("tb"))):
                    if left not in held:
                        held.clear()  # a leader's pairs follow each other
                        held[left] = shingles(left)
                    x, y = held[left], shingles(right)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_pydict({c: part.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")})

    return pairs.mapInArrow(run, "a long, b long").distinct()


def profiles(texts: DataFrame) -> DataFrame:
    """node, signature and the shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = [shingles(t) for t in as_bytes(part.column("text"))]
                items = [x.tobytes() for x in sets]
                yield pa.RecordBatch.from_pydict({
                    "node": part.column("doc_id"), "signature": pa.array([signature(x).tobytes() for x in sets], pa.binary()), "items": pa.array(items, pa.binary()),
                })

    return texts.mapInArrow(run, "node long, signature binary, items binary")


def linked_in_group(node: np.ndarray, comp: np.ndarray, signs: np.ndarray, items: list[np.ndarray]) -> np.ndarray:
    """Pairs that reach the similarity and join the components of a group; signatures sort out most others first.

    A pair is put out only if no earlier pairs of the group join its components already, so there are fewer pairs than
    components, and texts that are joined are not compared again.  All components that links reach are joined.
    """
    size = np.array([len(x) for x in items])
    offset = np.cumsum(size) - size
    names, flat = np.unique(np.concatenate(items), return_inverse=True)
    mark = np.zeros(len(names), np.bool_)
    label, place, count = np.unique(comp, return_inverse=True, return_counts=True)
    joined = np.arange(len(label))
    found = [np.zeros((0, 2), np.int64)]
    done = np.zeros(len(node), np.bool_)
    for k in np.argsort(count, kind="stable")[: len(label) - 1]:  # all but the largest: each pair has one of them
        inside = np.flatnonzero(place == k)
        done[inside] = True
        outside = np.flatnonzero(~done)
        for r in inside:
            outside = outside[joined[place[outside]] != joined[k]]
            hits = outside[(signs[outside] != signs[r]).sum(axis=1) <= FAR]
            hits = hits[100 * np.minimum(size[hits], size[r]) >= PERCENT * np.maximum(size[hits], size[r])]
            if not len(hits):
                continue
            mark[flat[offset[r] : offset[r] + size[r]]] = True
            n = size[hits]
            start = np.cumsum(n) - n
            spread = np.repeat(offset[hits] - start, n) + np.arange(int(n.sum()))
            shared = np.add.reduceat(mark[flat[spread]].astype(np.int64), start)
            mark[flat[offset[r] : offset[r] + size[r]]] = False
            hits = hits[100 * shared >= PERCENT * (n + size[r] - shared)]
            others, first = np.unique(joined[place[hits]], return_index=True)
            hits = hits[first]
            joined[np.isin(joined, others)] = joined[k]
            found.append(np.stack((np.minimum(node[hits], node[r]), np.maximum(node[hits], node[r])), axis=1))
    return np.unique(np.concatenate(found), axis=0)


def cross_pairs(members: DataFrame, comp: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of members (bucket, node) of one bucket that similarity links, but components do not yet: as many as
    join all components that such pairs join.

    Only buckets with several components take part.  Large buckets are cut into blocks; each two blocks meet in one
    group of bounded size, which compares whole shingle sets and puts out links alone.
    """
    members = members.join(comp, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    mixed = mixed.filter("low != high").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(mixed, "bucket")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    rows = rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "comp").join(known, "node")

    def run(table: pa.Table) -> pa.Table:
        node, comp = (np.asarray(table.column(c)) for c in ("node", "comp"))
        items = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        pairs = linked_in_group(node, comp, _signs(table.column("signature")), items)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return rows.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach; kept is doc_id = component_id.  Texts without
    words have an empty set and no links.  Rows without a doc_id have no links, no component and are kept.
    Rows that share a doc_id are one document with several texts.
    """
    with Scratch(docs.sparkSession, "neardup", BATCH_ROWS) as scratch:
        sets = scratch.stage(describe(docs), "sets", keep=True)
        linked = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
        # Equal sets are one node, named by its smallest doc_id.
        classes = scratch.stage(
            linked.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")),
            "classes", keep=True,
        )
        nodes = classes.select("node", "signature", "n_shingles")
        owned = scratch.stage(linked.join(classes, ["f1", "f2", "n_shingles"]).select("doc_id", "node"), "owned", keep=True)
        several = owned.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z")
        renamed = owned.join(several, "doc_id").select("a", F.col("node").alias("b"))

        # Keys are counted alone first: most have one node only, and all that follows reads repeated keys.
        keys = keyed(nodes)
        repeated = scratch.stage(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "repeated")
        held = scratch.stage(keys.join(repeated, "key"), "held")
        # Buckets with the same members are one bucket.
        buckets = held.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lead"), F.bit_xor(F.xxhash64("node")).alias("x"))
        buckets = scratch.stage(buckets.groupBy("n", "lead", "x").agg(F.min("key").alias("key")), "buckets")
        members = held.join(buckets.select("key", "lead"), "key").select(F.col("key").alias("bucket"), "lead", "node")
        members = scratch.stage(members, "members")
        # Written by itself, the optimizer sees how small the id table is and need not shuffle all texts for it.
        wanted = scratch.stage(members.select(F.col("node").alias("doc_id")).distinct(), "wanted")
        texts = scratch.stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi"), "texts")

        # First every member with the smallest of its bucket; then members of different components.
        stars = members.filter("lead != node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
        near_stars = scratch.stage(near_pairs(stars, nodes), "stars")
        links = scratch.stage(confirm(near_stars, texts).union(renamed), "links1")
        comp = scratch.stage(components(links, scratch), "components1")
        more = scratch.stage(confirm(cross_pairs(members, comp, profiles(texts)), texts), "links2")
        comp = scratch.stage(components(links.union(more), scratch), "components2", keep=True)

        # A document's component: the smallest node reached from its class.
        place = owned.join(comp, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("comp", "node")).alias("component_id"))
        rows = sets.select("doc_id", "n_shingles").join(place, "doc_id", "left")
        component = F.coalesce("component_id", "doc_id")
        return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, with all columns: that of the smallest doc_id, then hash of the text.

    Here every text is a document of its own, named by a hash of its id and text: rows that share an id and have unlike
    texts are not linked.  Rows equal in id and text are one; rows without a doc_id stay as they are.  Null texts, empty
    ones and texts without words have no links.  An empty table stays empty; all columns of ``docs`` are kept, whatever
    their names.
    """
    named = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("\x00null"))))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), named.alias("name"), "text")
    found = near_duplicates(rows.filter("name IS NOT NULL").select(F.col("name").alias("doc_id"), "text"))
    ids = rows.filter("name IS NOT NULL").select("id", F.col("name").alias("doc_id"))
    first = F.struct("id", F.col("doc_id").alias("name"))
    stays = found.select("doc_id", "component_id").join(ids, "doc_id").groupBy("component_id").agg(F.min(first).alias("first"))
    stay = rows.filter("name IS NOT NULL").join(stays.select(F.col("first.name").alias("name")), "name", "left_semi")
    # Rows equal in id and text share a name; any one of them stands for all.
    hashable = [F.col("row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    one = stay.groupBy("name").agg(F.min_by("row", F.xxhash64(*hashable)).alias("row")).select("row.*")
    return one.unionByName(rows.filter("name IS NULL").select("row.*"))
