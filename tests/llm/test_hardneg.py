"""Hard negatives against brute force, on ties, copies, odd rows and empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import DATA
from riskledger.llm import hardneg, queries

SCHEMA = "vec_id long, embedding array<float>, label int, key string, code string, score string, place string"


def brute(rows, every, top=5, least=80):
    """``rows``: (id, vector, label) that take part, one for each id."""
    ids = np.array([r[0] for r in rows])
    v = np.array([np.floor(256 * np.array(r[1], np.float32).astype(np.float64)) for r in rows]).astype(np.int64)
    label = np.array([r[2] for r in rows])
    out = []
    for a in np.flatnonzero(ids % every == 0):
        score = [int(x) for x in v @ v[a]]
        order = sorted(range(len(ids)), key=lambda j: (-score[j], ids[j]))
        for p in [j for j in order if label[j] == label[a] and j != a][:top]:
            fit = [j for j in order if label[j] != label[a] and least * score[p] <= 100 * score[j] <= 100 * score[p]]
            out += [(int(ids[a]), int(ids[p]), k + 1, int(ids[j]), score[p], score[j]) for k, j in enumerate(fit[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def made(n, size, labels, seed, ties=False):
    g = np.random.default_rng(seed)
    centre = g.standard_normal((6, size))
    v = centre[g.integers(0, 6, n)] + 0.5 * g.standard_normal((n, size))
    v = np.round(2 * v) / 2 if ties else v / np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, [float(x) for x in v[i]], int(g.integers(0, labels))) for i in range(n)]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    want = brute([(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows], 100)
    got = queries.op13_hard_negatives(spark, DATA)
    assert got.columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert want and result(got) == want


@pytest.mark.parametrize("size, ties", [(64, False), (3, True), (70, True), (1, True)])
def test_ties_sizes_and_batches(spark, size, ties):
    rows = made(700, size, 3, size, ties)
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(150)]  # copies with each label
    got = hardneg.hard_negatives(frame(spark, rows), 10, F.col("label"), batch=30)
    assert result(got) == brute(rows, 10)


def test_odd_rows(spark):
    rows = made(60, 4, 2, 1, True)
    odd = [
        (100, None, 1), (101, [1.0, None, 1.0, 1.0], 1), (102, [float("nan")] * 4, 0), (103, [float("inf")] * 4, 0), (104, rows[0][1], None),
        (None, rows[0][1], 0), (105, [1.0, 2.0], 1), (106, [], 1), (107, [1e30] * 4, 1),
    ]
    zero = [(110, [0.0] * 4, 0), (120, [0.0] * 4, 1), (130, [-0.001] * 4, 1)]
    repeated = [rows[7], rows[10], rows[10], (10, rows[10][1], rows[10][2] + 5), (11, [9.0] * 4, rows[11][2] + 5)]
    got = hardneg.hard_negatives(frame(spark, rows + odd + zero + repeated), 10, F.col("label"))
    assert result(got) == brute(rows + zero, 10)
    assert result(hardneg.hard_negatives(frame(spark, rows + odd).filter("vec_id % 10 <> 0"), 10, F.col("label"))) == []
    for none in (frame(spark, []), frame(spark, odd[:1])):
        got = hardneg.hard_negatives(none, 10, F.col("label"))
        assert got.columns[0] == "anchor_id" and got.count() == 0


def test_large_numbers_are_exact(spark):
    r = random.Random(3)
    rows = [(i, [float(r.randrange(1 << 22) + (1 << 21)) / 2 for _ in range(4)], i % 2) for i in range(40)]
    assert result(hardneg.hard_negatives(frame(spark, rows), 10, F.col("label"))) == brute(rows, 10)


@pytest.mark.parametrize("size", [1, 3, 64, 100])
def test_intervals_hold_every_score(size):
    g = np.random.default_rng(size)
    v = g.integers(-300, 300, (200, size)).astype("<i4")
    v[:20] = g.integers(-1, 2, (20, size))
    codes = hardneg.Codes(size)
    code, alignment, norm = codes.encode(v.astype(np.float64), codes.rotation)
    rows = hardneg.Rows(np.arange(200), np.zeros(200), v, code, alignment, norm)
    below, above = hardneg.Anchors.of(rows, codes).intervals(rows)
    true = v.astype(np.int64) @ v.T.astype(np.int64)
    assert (below <= true).all() and (true <= above).all()
    assert size < 64 or (above - below).mean() < 1.5 * np.outer(norm, norm).mean()  # less than without codes: 2


def test_best_keeps_the_first_of_equal_scores():
    best = hardneg.Best(2, 3)
    for at in range(0, 12, 4):
        scores = np.full((2, 4), 7)
        scores[1, 2:] = hardneg.NEVER
        best.add(np.array([1, 0]), scores, np.array([50, 40, 30, 20]) - at)
    assert best.key.tolist() == [[32, 36, 40], [12, 16, 20]] and (best.score == 7).all()
