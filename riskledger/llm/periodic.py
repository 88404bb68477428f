"""Periodic runs of words, found by an online sparse diagonal recursion.

A diagonal is a lag between two places of equal words.  Each word looks up its earlier occurrence and adds one to the
match length of that lag; a diagonal that ends with a sufficient length emits its run at once.  Frequent words have
many earlier occurrences, so the recursion is kept sparse by context: lags of ``2**k`` up to ``2**(k + 1) - 1`` are
followed by words that start an equal stretch of ``3 * 2**k`` words.

That loses no run and finds no other.  A run of smallest period q has at least 3q matches in a row, so it holds such a
stretch, and by Fine and Wilf none of its stretches has a period below ``2**k``.  Two occurrences of a stretch without
such a period are at least ``2**k`` apart, so the nearest earlier occurrence is the only one of that band: each word
has at most one active lag per band, whatever its frequency.  A nearest occurrence below the band means a smaller
period, which its own band finds.  Words whose stretch occurs once leave the recursion; longer stretches of theirs
cannot repeat either.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import as_bytes, pieces

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RESULT = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def classes(keys: np.ndarray) -> np.ndarray:
    """A number for each distinct key that occurs at least twice, -1 for the others."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    single = fresh & np.append(fresh[1:], True)
    out = np.empty(len(keys), np.int64)
    out[order] = np.where(single, -1, np.cumsum(fresh) - 1)
    return out


def paired(left: np.ndarray, right: np.ndarray, apart: int) -> np.ndarray:
    """Numbers of the stretches made of a stretch of ``left`` and one of ``right`` that starts ``apart`` later."""
    out = np.full(len(left), -1, np.int64)
    if apart < len(left):
        at = np.flatnonzero((left[:-apart] >= 0) & (right[apart:] >= 0))
        out[at] = classes(left[at] * (int(right.max(initial=0)) + 1) + right[at + apart])
    return out


def runs(numbers: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs among ``numbers``, sorted by start, then period.

    Several texts may follow one another if their numbers differ and a number of its own parts them; ``longest`` is
    the length of the longest text.
    """
    found = []
    whole, width = classes(numbers), 1  # the stretch of ``width`` words that starts at each word
    while LEAST_PERIODS * width <= longest and (whole >= 0).any():
        twice = paired(whole, whole, width)
        context = paired(twice, whole, 2 * width)
        at = np.flatnonzero(context >= 0)
        order = at[np.argsort(context[at], kind="stable")]
        earlier, later = order[:-1], order[1:]
        lag = later - earlier
        active = (context[earlier] == context[later]) & (lag >= width) & (lag < 2 * width)
        place, lag = later[active], lag[active]
        order = np.argsort(place)
        place, lag = place[order], lag[order]
        if len(place):
            # A word goes on with the diagonal of the word before it, or starts one.
            begins = np.append(True, (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1]))
            first = np.flatnonzero(begins)
            matches = np.diff(np.append(first, len(place))) + 3 * width - 1
            period = lag[first]
            enough = matches + period >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            found.append(np.stack((place[first] - period, matches + period, period), axis=1)[enough])
        whole, width = twice, 2 * width
    out = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def collapsed(words: list[bytes], own: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(own):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, own[:, 0] + own[:, 2], 1)
    np.add.at(edge, own[:, 0] + own[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def strongest(own: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most periods, compared exactly; of equal ones the first start, then the least period."""
    if not len(own):
        return None
    ratio = own[:, 1] / own[:, 2]
    near = own[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    return tuple(min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def summaries(texts: list[list[bytes]]) -> Iterator[tuple]:
    """The values of ``RESULT`` of each text, given as its words."""
    numbers: list[int] = []
    starts = []
    fresh = count()
    for words in texts:
        starts.append(len(numbers))
        own: defaultdict = defaultdict(fresh.__next__)
        numbers.extend(map(own.__getitem__, words))
        numbers.append(next(fresh))  # parts this text from the next
    found = runs(np.array(numbers, np.int64), max(map(len, texts), default=0))
    cut = np.searchsorted(found[:, 0], [*starts, len(numbers)])
    for words, start, a, b in zip(texts, starts, cut[:-1], cut[1:]):
        own = found[a:b] - (start, 0, 0)
        best = strongest(own)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own.tolist())
        yield (
            len(words), len(own), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, own))).hexdigest(),
        )


def periodic_runs(docs: DataFrame, carried: list[Column], planted: Column | None = None) -> DataFrame:
    """``carried`` columns with the values of ``RESULT`` of every whole ``text`` of ``docs``; one row for each row.

    Words are stretches without U+0009 to U+000D and U+0020, case kept.  ``planted`` (a number, or null for none)
    makes texts periodic before they are searched: with g = planted, word i from a = g % n on is original word
    a + (i - a) % (1 + (n - a) // (3 + g % 8)).

    Null, empty and blank texts have no word and no run.  Rows are independent, so repeated rows repeat their result,
    an empty table gives an empty one, and columns of ``docs`` that are not carried are not read.  Of runs with equally
    many periods the first start, then the least period is reported.  A very long text is searched whole, in memory
    in proportion to its words; short texts are searched together in batches of bounded size.
    """
    rows = docs.select(*carried, F.col("text").alias("_text"), (F.lit(None) if planted is None else planted).cast("long").alias("_planted"))
    kept = rows.schema.fields[:-2]
    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]

    def words_of(text: bytes | None, g: int | None) -> list[bytes]:
        words = text.split() if text else []
        if g is None or not words:
            return words
        a = g % len(words)
        rest = len(words) - a
        period = 1 + rest // (3 + g % 8)
        return words[:a] + (words[a : a + period] * (rest // period + 1))[:rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text", limit=1 << 20, rows=1024):
                texts = [words_of(t, g) for t, g in zip(as_bytes(part.column("_text")), part.column("_planted").to_pylist())]
                columns = zip(*summaries(texts))
                yield pa.RecordBatch.from_pydict({
                    **{f.name: part.column(i) for i, f in enumerate(kept)},
                    **{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)},
                })

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), RESULT])
    return rows.mapInArrow(run, schema)
