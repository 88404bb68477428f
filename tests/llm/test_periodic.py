"""Periodic runs against brute force over all lags."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from llm_rows import DATA
from riskledger.llm import periodic, queries


def brute_runs(words):
    """All (start, length, period), a lag at a time; a shorter period that divides the lag shows in the run itself."""
    place = {}
    w = np.array([place.setdefault(x, len(place)) for x in words])
    out = []
    for q in range(1, len(w) // 4 + 1):
        equal = np.concatenate(([False], w[q:] == w[:-q], [False]))
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        for s, e in zip(edge[::2], edge[1::2]):
            run = w[s : e + q]
            if len(run) >= max(6, 4 * q) and not any((run[r:] == run[:-r]).all() for r in range(1, q)):
                out.append((int(s), len(run), q))
    return sorted(out)


def brute_row(text, g=None):
    words = (text or "").encode().split()
    n = len(words)
    if g is not None and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n_},{q}\n" for s, n_, q in runs)
    milli = 1000 * best[1] // best[2] if best[2] else None
    return (n, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_equal_brute_force():
    r = random.Random(1)
    for _ in range(1500):
        n, k = r.randint(0, 90), r.choice([1, 2, 2, 3, 5, 20])
        w = [r.randrange(k) for _ in range(n)]
        if n > 3 and r.random() < 0.7:
            a = r.randrange(n)
            p = 1 + r.randrange(max(1, (n - a) // 3))
            for i in range(a + p, n):
                w[i] = w[i - p]
            if r.random() < 0.4:
                w[r.randrange(n)] = r.randrange(k)
        assert [tuple(x) for x in periodic.runs(np.array(w, np.int64), n).tolist()] == brute_runs(w)


def test_one_word_many_times_stays_cheap():
    found = periodic.runs(np.zeros(300_000, np.int64), 300_000)
    assert found.tolist() == [[0, 300_000, 1]]


def test_texts_of_a_batch_do_not_meet():
    texts = [["a", "b"] * 3, ["a", "b"] * 3, [], ["a"] * 6, ["a"] * 6]
    got = [row[:5] for row in periodic.summaries([[w.encode() for w in t] for t in texts])]
    assert got == [(6, 0, None, None, None), (6, 0, None, None, None), (0, 0, None, None, None), (6, 1, 0, 6, 1), (6, 1, 0, 6, 1)]


def test_strongest_run_is_compared_exactly():
    rows = np.array([[9, 8, 2], [3, 4, 1], [3, 12, 3], [0, 11, 3]])
    assert periodic.strongest(rows) == (3, 4, 1)


def test_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, DATA).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        h = zlib.crc32(str(doc_id).encode())
        assert got[doc_id] == brute_row(text, h // 10 if h % 10 == 0 else None), doc_id


def test_odd_rows(spark, odd, empty):
    got = periodic.periodic_runs(odd, [F.col("doc_id"), F.col("size"), F.col("text").alias("row")])
    assert got.columns[:3] == ["doc_id", "size", "row"] and got.count() == odd.count()
    for r in got.collect():
        if len(r["row"] or "") < 10_000:
            assert tuple(r)[3:] == brute_row(r["row"])
    assert periodic.periodic_runs(empty, [F.col("doc_id")]).count() == 0
