"""Toxicity: the risk against finite differences, its selection, held-out accuracy, odd rows and empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import DATA, ROW, rows_of, words
from riskledger.llm import queries, toxicity


def sample(seed, texts, cells):
    g = np.random.default_rng(seed)
    size = g.integers(0, 6, texts)
    return g.integers(0, cells, size.sum()), np.repeat(np.arange(texts), size), texts


@pytest.mark.parametrize("shift", [0.0, 3.0])
def test_gradient_of_the_risk(shift):
    positive, unlabelled = sample(1, 40, 12), sample(2, 70, 12)
    weights, prior = np.random.default_rng(3).standard_normal(12) + shift, 0.3
    _, slope, slant = toxicity.risk_step(weights, 0.2, positive, unlabelled, prior)

    def risk(w, b):
        return toxicity.risk_step(w, b, positive, unlabelled, prior)[0]

    for k in range(12):
        step = np.zeros(12)
        step[k] = 1e-6
        assert abs((risk(weights + step, 0.2) - risk(weights - step, 0.2)) / 2e-6 - slope[k]) < 1e-6
    assert abs((risk(weights, 0.2 + 1e-6) - risk(weights, 0.2 - 1e-6)) / 2e-6 - slant) < 1e-6


def test_negative_part_is_turned_round():
    """The unlabelled texts look less toxic than the prior allows: the part of the other class is below 0."""
    positive, unlabelled = (np.zeros(5, int), np.arange(5), 5), (np.zeros(0, int), np.zeros(0, int), 50)
    risk, slope, slant = toxicity.risk_step(np.array([6.0]), -6.0, positive, unlabelled, 0.5)
    assert risk == 0.5 * np.log(2)
    assert np.allclose(slope, 0.5 * 0.5) and np.isclose(slant, 0.5 * 0.5 - 1 / (1 + np.exp(6)))


def test_features_by_hand():
    cell, owner = toxicity.features(["Abcdef abc! ABC", None, "", "12 _", "abcdefgh ÉÉÉ"])
    got = [set(cell[owner == i].tolist()) for i in range(5)]
    assert [len(x) for x in got] == [2 + 2, 0, 0, 0, 2 + 4 + 2]  # abcd, abcde; abcd to abcdefg, and 4 and 5 bytes of three letters
    assert len(got[0] & got[4]) == 2 and cell.dtype == np.uint64
    assert len(cell) == len({*zip(cell.tolist(), owner.tolist())})


def test_copies_share_a_sketch():
    text = words(1, 200)
    assert toxicity.sketch(text) == toxicity.sketch(text.upper()) != toxicity.sketch(words(2, 200))
    assert toxicity.sketch(None) == toxicity.sketch("!!") == 0 != toxicity.sketch("two words")


def planted(n, seed=4):
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.15
        body = words(1000 + i, r.randint(20, 60)).split()
        if toxic:
            body[r.randrange(len(body))] = r.choice(["Zzvile,", "zzqrude"])
        texts.append((i, " ".join(body)))
        if r.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return texts, labels


def test_planted_words_are_learned_and_only_positives_count(spark, empty):
    texts, labels = planted(800)
    docs = spark.createDataFrame(rows_of(texts), ROW)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    positive_only = marks.filter("toxic = 1").unionByName(spark.createDataFrame([(1, 1, None), (None, 1, 1)], marks.schema))
    for labelled, prior in ((marks, None), (positive_only, 0.15)):
        model = toxicity.fit(docs, labelled, F.col("doc_id") % 4 != 2, prior)
        got = toxicity.predict(docs, model, [F.col("doc_id"), F.col("score").alias("row")]).collect()
        assert len(got) == 800 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
        want = {i: int("zz" in t.lower()) for i, t in texts}
        assert np.mean([r["predicted"] == want[r["doc_id"]] for r in got if r["doc_id"] % 4 == 2]) > 0.97
    again = toxicity.fit(docs, positive_only, F.col("doc_id") % 4 != 2, prior)
    assert np.array_equal(again.cells, model.cells) and np.allclose(again.weights, model.weights)
    nothing = toxicity.fit(docs, marks.limit(0), F.lit(True))
    assert {round(r["score"], 12) for r in toxicity.predict(docs, nothing, []).collect()} == {toxicity.PRIOR}
    assert toxicity.predict(empty, toxicity.fit(empty, marks, F.lit(True)), [F.col("doc_id")]).count() == 0


def test_odd_rows(odd):
    model = toxicity.Classifier(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    got = toxicity.predict(odd, model, [F.col("doc_id"), F.col("size"), F.col("text").alias("row")])
    assert got.columns == ["doc_id", "size", "row", "score", "predicted"] and got.count() == odd.count()
    assert {r["score"] for r in got.collect()} == {1 / (1 + np.exp(1.0))}


def test_query(spark, docs):
    got = queries.op12_toxicity(spark, DATA)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    assert got.filter("held_out <> (pmod(crc32(cast(doc_id as string)), 4) = 2)").count() == 0
