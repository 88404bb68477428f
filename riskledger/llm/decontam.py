"""Benchmark decontamination by the q-gram lemma.

Texts and items are lower-cased, white space is one blank.  An item of L characters may differ from a passage in
k = ``EDIT_SHARE`` * L edits.  Such a passage shares at least L - q + 1 - k * q of the item's q-grams, and all of
them lie on diagonals (position in the text minus position in the item) that differ by at most k.  Diagonals are cut
into bands of 2 (k + 1) that overlap by half, so one band holds them all.  Bands with enough q-grams are verified by
an alignment within the band.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import pieces

Q = 12
EDIT_SHARE = 0.06
#: Characters of items that one pass holds; more items take more passes.
INDEX_CHARS = 4 << 20
_STEP = 1 << 19
_BAND_ZERO = 1 << 30  # bands of passages that begin before their text are negative
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def fold(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
                    steps = np.full(max(n, 1 << 20), base, np.uint64)
                    steps[0] = 1
                    setattr(cls, name, np.cumprod(steps, dtype=np.uint64))


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    _Powers.upto(len(codes))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * _Powers.up[: len(codes)], out=sums[1:])
        value = (sums[Q:] - sums[:-Q]) * _Powers.down[: len(codes) - Q + 1]
        return value * _SPREAD


class Index:
    """The q-grams of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.texts = [], []
        self.short: list[tuple[int, str]] = []
        for name, text in sorted(items):
            folded = fold(text)
            if len(folded) >= Q:
                self.ids.append(name)
                self.texts.append(folded)
            elif folded:
                self.short.append((name, folded))
        size = np.array([len(t) for t in self.texts], np.int64)
        self.size = size
        self.edits = np.minimum((EDIT_SHARE * size).astype(np.int64), (size - Q) // Q)
        self.least = size - Q + 1 - self.edits * Q
        self.codes = [code_points(t) for t in self.texts]
        grams = [gram_hashes(c) for c in self.codes]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.gram, self.start = np.unique(flat[order], return_index=True)
        self.stop = np.append(self.start[1:], len(flat))
        self.bits = max(16, int(len(self.gram) * 32).bit_length())
        self.shift = np.uint64(64 - self.bits)
        self.filter = np.zeros(1 << self.bits, np.bool_)
        self.filter[(self.gram >> self.shift).astype(np.int64)] = True
        self.reach = int((size + 4 * self.edits + 4).max()) if len(size) else 0

    def find(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, end) for the best passage of every item in every folded text."""
        best: dict[tuple[int, int], tuple[int, int]] = {}

        def note(row: int, item: int, edits: int, end: int) -> None:
            key = (row, item)
            if key not in best or (edits, end) < best[key]:
                best[key] = (edits, end)

        for row, text in enumerate(texts):
            for name, short in self.short:
                at = f" {text} ".find(f" {short} ")
                if at >= 0:
                    note(row, name, 0, at + len(short))
        owner, offset, parts = [], [], []
        for row, text in enumerate(texts):
            for at in range(0, max(len(text), 1), _STEP):
                owner.append(row)
                offset.append(at)
                parts.append(text[at : at + _STEP + self.reach])
        if parts and len(self.gram):
            codes = code_points("\0".join(parts)).astype(np.uint64)
            starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
            for item, band in self.bands(gram_hashes(codes)):
                k, size = int(self.edits[item]), int(self.size[item])
                low = band * (k + 1) - k
                edits, end = aligned(self.codes[item], codes, low, 4 * k + 2)
                if edits <= k:
                    part = int(np.searchsorted(starts, min(max(end - 1, 0), len(codes) - 1), "right")) - 1
                    note(owner[part], self.ids[item], edits, end - int(starts[part]) + offset[part])
        return [(row, item, *found) for (row, item), found in sorted(best.items())]

    def bands(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) with enough distinct q-grams of the item."""
        at = np.flatnonzero(self.filter[(hashes >> self.shift).astype(np.int64)])
        if not len(at):
            return []
        slot = np.minimum(np.searchsorted(self.gram, hashes[at]), len(self.gram) - 1)
        true = self.gram[slot] == hashes[at]
        at, slot = at[true], slot[true]
        n = self.stop[slot] - self.start[slot]
        ahead = np.repeat(np.cumsum(n) - n, n)
        entry = np.repeat(self.start[slot], n) + np.arange(int(n.sum())) - ahead
        item, place = self.item[entry], self.place[entry]
        width = self.edits[item] + 1
        band = (np.repeat(at, n) - place) // width
        key = np.concatenate((item << 40, item << 40)) + np.concatenate((band, band - 1)) + _BAND_ZERO
        place = np.concatenate((place, place))
        name, back, size = np.unique(key, return_inverse=True, return_counts=True)
        likely = size >= self.least[name >> 40]
        if not likely.any():
            return []
        keep = likely[back]
        pairs = np.unique(np.stack((back[keep], place[keep]), axis=1), axis=0)
        distinct = np.bincount(pairs[:, 0], minlength=len(name))
        good = name[likely & (distinct >= self.least[name >> 40])]
        return [(x >> 40, (x & ((1 << 40) - 1)) - _BAND_ZERO) for x in good.tolist()]


def aligned(item: np.ndarray, codes: np.ndarray, low: int, width: int) -> tuple[int, int]:
    """Fewest edits of ``item`` against a passage on diagonals ``low`` to ``low + width``, and the passage's end."""
    padded = np.full(len(item) + width, 0xFFFFFFFF, np.uint64)
    first, last = max(low, 0), min(low + len(padded), len(codes))
    if last > first:
        padded[first - low : last - low] = codes[first:last]
    step = np.arange(width + 1)
    cost = np.zeros(width + 1, np.int64)
    for i, c in enumerate(item):
        kept = cost + (padded[i : i + width + 1] != c)
        kept[:width] = np.minimum(kept[:width], cost[1:] + 1)
        cost = np.minimum.accumulate(kept - step) + step
    best = int(cost.argmin())
    return int(cost[best]), low + len(item) + best


def indexes(benchmark: DataFrame) -> list[Index]:
    """Indexes of all items (item_id, text), each of a bounded number of characters; null ids or texts match nothing."""
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-total // INDEX_CHARS))
    out = []
    for i in range(passes):
        part = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).collect()
        out.append(Index([(r["item_id"], r["text"]) for r in part]))
    return out


def _finder(held: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", limit=1 << 19):
                found = held.value.find([fold(t) for t in part.column("text").to_pylist()])
                rows = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(rows),
                    **{c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate(("item_id", "edits", "passage_end"), 1)},
                })

    return run


def _holder(held: Broadcast) -> Callable[[Column], Column]:
    @F.arrow_udf("boolean")
    def holds(text: pa.Array) -> pa.Array:
        out, at = np.zeros(len(text), np.bool_), 0
        for part in pieces(pa.RecordBatch.from_arrays([text], ["text"]), "text", limit=1 << 19):
            found = held.value.find([fold(t) for t in part.column("text").to_pylist()])
            out[[at + f[0] for f in found]] = True
            at += part.num_rows
        return pa.array(out)

    return holds


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits and passage_end (in the folded text) for every item a text of ``docs`` holds.

    Null and empty texts hold none.  Repeated rows are reported each.  Items shorter than a q-gram must occur as whole
    words without edits.
    """
    out = None
    for index in indexes(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)  # INDEX_CHARS characters at most

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        part = rows.mapInArrow(_finder(held), "doc_id long, item_id long, edits long, passage_end long")
        out = part if out is None else out.union(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    for index in indexes(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)
        rows = rows.filter(~_holder(held)(F.col("text")))
    return rows.select("row.*")
