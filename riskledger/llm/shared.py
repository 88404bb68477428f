"""Helpers of the corpus operators: tables of the shared folder, batches of bounded size, text hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.workspace import fresh_path

#: ASCII words: everything between the characters U+0009 to U+000D and U+0020.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of a table that may be broadcast; beyond it a plain join is left to the optimizer.
SMALL_ROWS = 10_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(spark: SparkSession, path: str):
    """The store of ``path`` and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    store, place = file_system(spark, path)
    return store.exists(place)


class Scratch:
    """Tables that one operator writes to the shared folder; those no result reads go when it ends.

    A staged table cuts the lineage: a lost executor costs a re-read, and all later steps see the
    very same rows.  ``keep=True`` marks a table that the returned, lazy result still reads.  With ``batch_rows`` the
    batches that staged steps hand to Python have so many rows at most: whole texts then take little memory at a time.
    """

    def __init__(self, spark: SparkSession, label: str, batch_rows: int | None = None):
        self.spark, self.label, self.batch_rows = spark, label, batch_rows
        self.passing: list[str] = []

    def __enter__(self) -> Scratch:
        if self.batch_rows:
            self.usual_rows = self.spark.conf.get(BATCH_SETTING)
            self.spark.conf.set(BATCH_SETTING, str(self.batch_rows))
        return self

    def stage(self, df: DataFrame, name: str, keep: bool = False, codec: str | None = None) -> DataFrame:
        path = fresh_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path, compression=codec)
        if not keep:
            self.passing.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads, before the operator ends."""
        starts = tuple(f"{self.label}-{name}-" for name in names)
        gone = [path for path in self.passing if path.rsplit("/", 1)[1].startswith(starts)]
        self.passing = [path for path in self.passing if path not in gone]
        for path in gone:
            store, place = file_system(self.spark, path)
            store.delete(place, True)

    def __exit__(self, *error) -> None:
        if self.batch_rows:
            self.spark.conf.set(BATCH_SETTING, self.usual_rows)
        for path in self.passing:
            store, place = file_system(self.spark, path)
            store.delete(place, True)


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` (already staged) with a broadcast hint if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 << 20, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of ``column`` each (one row at least)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and (held + n > limit or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def fold_remainder(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % modulus


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit of unsigned 64-bit numbers over all output bits."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class Prefixes:
    """Hashes of any span of a byte string, from running sums of a polynomial modulo 2**64."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, data: bytes):
        n = len(data)
        if len(Prefixes.powers) < n + 1:
            size = max(2 * len(Prefixes.powers), n + 1, 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                    steps = np.full(size, base, np.uint64)
                    steps[0] = 1
                    setattr(Prefixes, name, np.cumprod(steps, dtype=np.uint64))
        with np.errstate(over="ignore"):
            codes = _BYTE_CODES[np.frombuffer(data, np.uint8)] * Prefixes.powers[:n]
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes, out=self.sums[1:], dtype=np.uint64)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * Prefixes.inverse[starts] + (ends - starts).astype(np.uint64))


def folded_words(text: bytes | None) -> bytes:
    """ASCII letters lower-cased and words joined by single blanks."""
    return b" ".join(text.lower().split()) if text else b""


def word_bounds(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a string that ``folded_words`` made."""
    if not line:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(line)]))
