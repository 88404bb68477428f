"""Language of whole texts by string kernels.

The kernel of two texts is the number of blended character n-grams (one to three characters of the
lower-cased letters, other characters count as one blank) that are present in both, over the
geometric mean of their own numbers: a blended-spectrum presence kernel.  n-grams are hashed to
``BUCKETS`` cells.  A few landmark texts per language give a Nyström map, on which one kernel ridge
regression per language is solved; texts are scored by two matrix products per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.llm.shared import pieces

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Bounds of the fitted sample, shared out evenly over the languages.
LANDMARKS = 128
TRAINING_ROWS = 8192
_PRIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)
    return _letters


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One 0/1 row of ``BUCKETS`` cells per text, and whether it has a letter.  A long text is read whole."""
    cells = np.zeros((len(texts), BUCKETS), np.uint8)
    lettered = np.zeros(len(texts), np.bool_)
    parts = [f" {text.lower()} " if text else "" for text in texts]
    if not any(parts):
        return cells, lettered
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    letter = letter_table()[codes]
    lettered[owner[letter]] = True
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    owner, codes = owner[keep], np.where(letter, codes, np.uint32(32))[keep].astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(codes) < n:
                continue
            end = len(codes) - n + 1
            value = np.full(end, np.uint64(n))
            for k in range(n):
                value = (value + codes[k : k + end]) * _PRIMES[k]
            value ^= value >> np.uint64(29)
            cell = ((value * _PRIMES[0]) >> np.uint64(64 - 15)).astype(np.int64)
            same = owner[:end] == owner[n - 1 :]
            cells[owner[:end][same], cell[same]] = 1
    cells[~lettered] = 0
    return cells, lettered


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # float32, one row of cells per landmark
    weights: np.ndarray  # landmark x language: Nyström map and ridge coefficients in one
    offsets: np.ndarray

    def kernel(self, cells: np.ndarray) -> np.ndarray:
        return kernel(cells, self.landmarks)

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        cells, lettered = presence(texts)
        value = self.kernel(cells) @ self.weights + self.offsets
        best = value.argmax(axis=1)
        score = np.clip(value[np.arange(len(best)), best], 0.0, 1.0)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0)


def kernel(cells: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Presence kernels of every row with every landmark, by one matrix product."""
    rows = cells.astype(np.float32)
    own = np.sqrt(np.maximum(rows.sum(axis=1), 1.0))
    return (rows @ landmarks.T) / own[:, None] / np.sqrt(np.maximum(landmarks.sum(axis=1), 1.0))[None, :]


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, column, limit=1 << 19, rows=64)


def bounded_sample(rows: DataFrame, group: str, key: str, per_group: int, counts: dict, seed: int) -> DataFrame:
    """At most ``per_group`` rows of every group, those with the smallest hashes of ``key`` and text.

    A hash threshold from the group sizes leaves about twice the wanted rows, so the exact cut sorts
    a bounded number of rows.
    """
    order = F.xxhash64(F.col(key), F.col("text"), F.lit(seed))  # the text parts rows that share a key
    place = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    wanted = F.create_map(*[F.lit(x) for name, n in sorted(counts.items()) for x in (name, min(1.0, 2.0 * per_group / n))])
    few = rows.filter(place < wanted[F.col(group)])
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order, key))
    return few.withColumn("_rank", rank).filter(F.col("_rank") <= per_group)


def fit(docs: DataFrame, eligible: Column, ridge: float = 1e-3, seed: int = 11) -> LanguageModel:
    """Learns from rows of ``docs`` (doc_id, text, lang) that are ``eligible`` and have a text and a language.

    Landmarks and training rows are a bounded sample (``LANDMARKS``, ``TRAINING_ROWS``); their
    kernel rows are computed on the executors, and only those numbers reach the driver.
    """
    rows = docs.filter(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(counts))
    if not names:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0)), np.zeros(0))
    rows = rows.select("doc_id", "lang", "text")

    def packed_cells(batches):
        for batch in _batches(batches, "text"):
            cells, lettered = presence(batch.column("text").to_pylist())
            bits = [r.tobytes() for r in np.packbits(cells, axis=1)]
            yield pa.RecordBatch.from_pydict({"bits": pa.array(bits, pa.binary()), "ok": pa.array(lettered)})

    sample = bounded_sample(rows, "lang", "doc_id", max(4, LANDMARKS // len(names)), counts, seed)
    found = sample.select("text").mapInArrow(packed_cells, "bits binary, ok boolean").filter("ok").orderBy("bits").collect()
    if not found:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0)), np.zeros(0))
    bits = np.stack([np.frombuffer(r["bits"], np.uint8) for r in found])
    landmarks = np.unpackbits(bits, axis=1).astype(np.float32)

    def kernel_rows(batches):
        for batch in _batches(batches, "text"):
            cells, lettered = presence(batch.column("text").to_pylist())
            values = [r.tobytes() for r in kernel(cells, landmarks).astype(np.float32)]
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column("lang").cast(pa.string()), "k": pa.array(values, pa.binary()), "ok": pa.array(lettered)}
            )

    sample = bounded_sample(rows, "lang", "doc_id", max(8, TRAINING_ROWS // len(names)), counts, seed + 1)
    found = sample.select("lang", "text").mapInArrow(kernel_rows, "lang string, k binary, ok boolean").filter("ok").collect()
    found.sort(key=lambda r: (r["lang"], r["k"]))
    if not found:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0)), np.zeros(0))
    k = np.stack([np.frombuffer(r["k"], np.float32) for r in found]).astype(np.float64)
    target = np.array([[float(r["lang"] == name) for name in names] for r in found])
    # Nyström: inverse square root of the landmark kernel, small directions left out.
    own = kernel(landmarks, landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    phi = k @ root
    centre, prior = phi.mean(axis=0), target.mean(axis=0)
    gram = (phi - centre).T @ (phi - centre) + ridge * len(phi) * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, (phi - centre).T @ (target - prior))
    return LanguageModel(names, landmarks, (root @ beta).astype(np.float32), (prior - centre @ beta).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, carried: list[Column]) -> DataFrame:
    """``carried`` columns with lang_pred and score of every whole ``text``.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was learned.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x LANDMARKS numbers at most
    rows = docs.select(*carried, F.col("text").alias("_text"))

    def run(batches):
        for batch in _batches(batches, "_text"):
            names, score = held.value.score(batch.column("_text").to_pylist())
            columns = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict({**columns, "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
