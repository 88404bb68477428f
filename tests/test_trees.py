"""Tree learners over binned rows against plain numpy."""

import dataclasses
import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskledger.operators import learners as L
from riskledger.operators import trees as T
from riskledger.sources.models import read_model, write_model


@pytest.fixture(scope="module")
def flags(spark):
    """500 rows of two numbers and three flags."""
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(size=(500, 2)), rng.random((500, 3)) < [0.5, 0.2, 0.02]].astype(float)
    y = (x @ [1.0, -0.5, 1.2, -2.0, 1.0] + rng.normal(size=500) > 0.7).astype(int)
    rows = [(f"{i:04d}", int(y[i]), Vectors.dense(x[i])) for i in range(500)]
    return spark.createDataFrame(rows, ["claim_id", "label", "features"]).repartition(3).cache(), x, y


def grow(x, g, w, cuts, depth, min_leaf):
    """A regression tree by trying every cut of every feature: what it predicts for each row."""
    mean = (w * g).sum() / w.sum()
    best, own = (1e-12, None), (w * g).sum() ** 2 / w.sum()
    for j, places in enumerate(cuts if depth else []):
        for cut in places:
            left = x[:, j] <= cut
            if min(left.sum(), (~left).sum()) >= min_leaf:
                fall = sum((w[s] * g[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - own
                if fall > best[0] + 1e-9:
                    best = fall, (j, cut)
    if best[1] is None:
        return np.full(len(x), mean)
    left, out = x[:, best[1][0]] <= best[1][1], np.empty(len(x))
    for side in (left, ~left):
        out[side] = grow(x[side], g[side], w[side], cuts, depth - 1, min_leaf)
    return out


@pytest.mark.parametrize("positive, min_leaf", [(1.0, 20), (3.6, 1)])
def test_boosting_equals_trying_every_cut(flags, positive, min_leaf):
    frame, x, y = flags
    model = L.fit_boosted(frame, rounds=8, depth=3, row_share=1.0, min_leaf=min_leaf, positive_weight=positive)
    cuts, sign, w = T.cut_points(frame), 2.0 * y - 1.0, np.where(y == 1, positive, 1.0)
    margin = grow(x, sign, w, cuts, 3, min_leaf)
    for _ in range(7):
        margin += 0.05 * grow(x, 4 * sign / (1 + np.exp(2 * sign * margin)), w, cuts, 3, min_leaf)
    got = {r["claim_id"]: r["prob"] for r in model.score(frame).collect()}
    np.testing.assert_allclose([got[f"{i:04d}"] for i in range(500)], 1 / (1 + np.exp(-2 * margin)), rtol=1e-9)
    first = model.model.trees[0]
    assert first._call_java("rootNode").impurity() == pytest.approx(1 - ((w * sign).sum() / w.sum()) ** 2)


def test_draws_do_not_depend_on_partitions(flags):
    """Spark's learner draws rows by the number of their partition."""
    frame = flags[0]
    one, other = (L.fit_boosted(f, rounds=4).score(frame).select("claim_id", "prob") for f in (frame, frame.repartition(7)))
    assert one.join(other.withColumnRenamed("prob", "b"), "claim_id").filter(F.abs(F.col("prob") - F.col("b")) > 1e-9).count() == 0


def test_forest_nodes_hold_the_drawn_rows(spark, flags, tmp_path):
    """Every tree draws about as many rows as there are, each node's sums are its children's, and a split is the best of its features."""
    frame, x, y = flags
    grown, cuts = T.forest_trees(frame, 12, 4, 5, (1.0, 2.0), 7)
    assert len({t.rows[0] for t in grown}) > 1
    for tree in grown:
        assert abs(tree.rows[0] - 500) < 5 * math.sqrt(500)
        inner = np.flatnonzero(tree.feature >= 0)
        assert len(inner) and (tree.rows[2 * inner + 1] >= 5).all() and (tree.rows[2 * inner + 2] >= 5).all()
        np.testing.assert_allclose(tree.stats[inner], tree.stats[2 * inner + 1] + tree.stats[2 * inner + 2])
        np.testing.assert_allclose(tree.rows, tree.stats @ [1.0, 0.5], atol=1e-9)

        def gini(s):
            return 1 - ((s / s.sum()) ** 2).sum()

        for i in inner:
            whole, left, right = (tree.stats[k] for k in (i, 2 * i + 1, 2 * i + 2))
            assert tree.gain[i] == pytest.approx(gini(whole) - (left.sum() * gini(left) + right.sum() * gini(right)) / whole.sum())
    model = L.fit_forest(frame, trees=12, depth=4, min_leaf=5)
    write_model(spark, model, str(tmp_path / "forest"))
    pair = model.score(frame, "a").join(read_model(spark, str(tmp_path / "forest")).score(frame, "b").select("claim_id", "b"), "claim_id")
    assert pair.count() == 500 and pair.filter("abs(a - b) > 1e-12").count() == 0


def test_one_class_and_constant_columns_give_a_leaf(spark):
    rows = [(f"{i}", 0, Vectors.dense([1.0, float(i % 2)])) for i in range(30)]
    frame = spark.createDataFrame(rows, ["claim_id", "label", "features"])
    for model in (L.fit_boosted(frame, rounds=2, row_share=1.0), L.fit_forest(frame, trees=3)):
        assert model.score(frame).agg(F.max("prob")).first()[0] < 0.2


def test_rare_values_keep_their_cuts(spark):
    """A flag that one row in a thousand has is below every quantile."""
    rows = [(f"{i}", Vectors.dense([float(i == 500), float(i)])) for i in range(1000)]
    cuts = T.cut_points(spark.createDataFrame(rows, ["claim_id", "features"]))
    assert cuts[0].tolist() == [0.5] and len(cuts[1]) == 31


def test_models_fitted_together_are_those_fitted_alone(flags, monkeypatch):
    """Each model has its own rows, rounds and depth; together they take as many passes as the longest one alone."""
    frame = flags[0].withColumn("_fold", F.pmod(F.hash("claim_id"), F.lit(3)))
    fits = [L.boosting(rounds=9, depth=3, min_leaf=20), L.boosting(3.6, rounds=7, depth=4, row_share=1.0), *[L.boosting(rounds=9, depth=3, without=k) for k in range(3)]]
    passes, whole = [], T.total
    monkeypatch.setattr(T, "total", lambda blocks, sums: passes.append(1) or whole(blocks, sums))
    together, shared = T.boosted_together(frame, fits, 7), len(passes)
    alone = []
    for how in fits:
        rows = frame if how.without is None else frame.filter(F.col("_fold") != how.without)
        passes.clear()
        alone.append((*T.boosted_together(rows, [dataclasses.replace(how, without=None)], 7)[0], len(passes)))
    assert shared == max(n for _, _, n in alone)
    for (grown, cuts), (own, own_cuts, _) in zip(together, alone):
        assert len(grown) == len(own) and all((a == b).all() for a, b in zip(cuts, own_cuts))
        for a, b in zip(grown, own):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all()
            np.testing.assert_allclose(a.stats, b.stats, rtol=1e-9, atol=1e-9)
