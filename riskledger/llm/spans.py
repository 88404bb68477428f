"""Substring deduplication by sliding runs of sentences.

A text is cut after sentence marks and at line breaks.  Every run of one to three consecutive sentences
that is long enough (``MIN_WORDS`` for runs of one, two and three) is hashed on its lower-cased words, and where
three sentences are too short, the shortest longer run that has as many words as a run of three needs.  Runs
that occur more than once in all texts keep their first occurrence (by doc_id, text hash, position); sentences
that any other occurrence covers are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import Prefixes, Scratch, pieces

#: Least words of a run of one, two and three or more sentences.
MIN_WORDS = (40, 24, 12)
_CUT = re.compile(r"[.!?]+\s+|\n+")


def sentences(text: str) -> list[str]:
    """Consecutive parts of ``text``, each with its closing marks and white space; joined they are the text."""
    ends = [m.end() for m in _CUT.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def runs(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, length and hash of every run of ``text`` that is long enough."""
    if not text:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)
    words = [s.lower().split() for s in sentences(text)]
    folded = [b" ".join(w.encode("utf-8", "surrogatepass") for w in ws) for ws in words]
    count = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    size = np.array([len(f) for f in folded])
    end = np.cumsum(size + 1) - 1
    start = end - size
    hashed = Prefixes(b"\n".join(folded))
    place, length, value = [], [], []
    for k, least in enumerate(MIN_WORDS, 1):
        if len(words) < k:
            break
        first = np.arange(len(words) - k + 1)
        good = first[(count[first + k] - count[first] >= least)]
        place.append(good)
        length.append(np.full(len(good), k))
        value.append(hashed.spans(start[good], end[good + k - 1]))
    # One run more for a start whose three sentences are too short, whatever its number of sentences.
    first = np.arange(max(len(words) - 3, 0))
    first = first[count[first + 3] - count[first] < MIN_WORDS[2]]
    stop = np.searchsorted(count, count[first] + MIN_WORDS[2])
    first, stop = first[stop <= len(words)], stop[stop <= len(words)]
    place.append(first)
    length.append(stop - first)
    value.append(hashed.spans(start[first], end[stop - 1]))
    return np.concatenate(place).astype(np.int32), np.concatenate(length).astype(np.int32), np.concatenate(value).view(np.int64)


def all_runs(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", limit=1 << 20):
                found = [runs(t) for t in part.column("text").to_pylist()]
                n = np.array([len(f[0]) for f in found])
                row = pa.array(np.repeat(np.arange(part.num_rows), n))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(row), "h": part.column("h").take(row),
                    **{c: pa.array(np.concatenate([f[i] for f in found])) for i, c in enumerate(("pos", "len", "run"))},
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").filter("text IS NOT NULL")
    return rows.mapInArrow(run, "doc_id long, h long, pos int, len int, run long")


def without(text: str | None, places: list[int] | None, lengths: list[int] | None) -> tuple[str | None, int, int]:
    """The text without covered sentences, its number of sentences, and how many were removed."""
    if not text:
        return text, 0, 0
    parts = sentences(text)
    drop = np.zeros(len(parts) + 1, np.int64)
    for p, k in zip(places or (), lengths or ()):
        drop[p] += 1
        drop[p + k] -= 1
    gone = np.cumsum(drop)[:-1] > 0
    return ("".join(s for s, g in zip(parts, gone) if not g) if gone.any() else text), len(parts), int(gone.sum())


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text without later occurrences of repeated runs, n_sentences and n_removed of every row of ``docs``.

    Null and empty texts have no sentences and stay as they are.  Rows with equal id and text are one document: both
    rows get the same text.  Rows without an id come last in the order of occurrences.
    """
    with Scratch(docs.sparkSession, "spans") as scratch:
        found = all_runs(docs)
        where = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("h").alias("h"), F.col("pos").alias("p"))
        repeated = found.groupBy("run").agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1").select("run", "first")
        later = found.join(repeated, "run").filter(where != F.col("first")).select("doc_id", "h", "pos", "len").distinct()
        covered = later.groupBy("doc_id", "h").agg(F.collect_list(F.struct("pos", "len")).alias("runs"))
        covered = scratch.stage(covered.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "runs"), "covered", keep=True)

        @F.arrow_udf("struct<text: string, n_sentences: int, n_removed: int>")
        def cleaned(text: pa.Array, place: pa.Array, length: pa.Array) -> pa.Array:
            rows = [without(*r) for r in zip(text.to_pylist(), place.to_pylist(), length.to_pylist())]
            names, kinds = ("text", "n_sentences", "n_removed"), (pa.string(), pa.int32(), pa.int32())
            return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], list(names))

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
        rows = rows.join(covered, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
        out = rows.select("doc_id", cleaned(F.col("text"), F.col("runs.pos"), F.col("runs.len")).alias("c"))
        return out.select("doc_id", "c.text", "c.n_sentences", "c.n_removed")
