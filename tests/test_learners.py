import inspect

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskledger import constants as K
from riskledger.operators import ensembles as N
from riskledger.operators import learners as L
from riskledger.operators import passes as S
from riskledger.operators.matrix import fit_matrix
from riskledger.operators.metrics import score_summary
from riskledger.plans import experiments as P
from riskledger.sources.models import read_model, write_model


@pytest.fixture(scope="module")
def sample(spark):
    """600 rows, three features, a noisy linear label."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3))
    y = (x @ [1.5, -1.0, 0.3] + rng.normal(size=600) > 0.8).astype(int)
    rows = [(f"{i:05d}", int(y[i]), Vectors.dense(x[i])) for i in range(600)]
    return spark.createDataFrame(rows, ["claim_id", "label", "features"]).repartition(2).cache(), x, y


def newton(x, y, w, c):
    """Weighted L2 logistic regression by Newton steps; the intercept is not penalised."""
    a = np.c_[x, np.ones(len(x))]
    b, penalty = np.zeros(a.shape[1]), np.eye(a.shape[1])
    penalty[-1, -1] = 0
    for _ in range(40):
        p = 1 / (1 + np.exp(-a @ b))
        b -= np.linalg.solve(c * (a.T * (w * p * (1 - p))) @ a + penalty, c * a.T @ (w * (p - y)) + penalty @ b)
    return b


@pytest.mark.parametrize("weights, c", [("balanced", 0.1), (None, 10.0), ({0: 1.0, 1: 4.0}, 1.0)])
def test_logistic_equals_newton(sample, weights, c):
    frame, x, y = sample
    table = {"balanced": {k: len(y) / (2 * (y == k).sum()) for k in (0, 1)}, None: {0: 1.0, 1: 1.0}}.get(weights if not isinstance(weights, dict) else 0, weights)
    want = newton(x, y, np.array([table[k] for k in y]), c)
    model = L.fit_logistic(frame, c, weights, tol=1e-10).model
    assert np.append(model.coefficients.toArray(), model.intercept) == pytest.approx(want, abs=1e-4)


def test_sigmoid_equals_newton_on_smoothed_targets(sample, spark):
    frame, x, y = sample
    scored = L.fit_logistic(frame, 1.0).margin(frame)
    fitted = N.fit_sigmoid(scored)
    got = np.array([(r.margin, r.label) for r in scored.collect()])
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    want = newton(got[:, :1], np.where(got[:, 1] == 1, high, low), np.ones(600), 1e12)
    assert (fitted.slope, fitted.offset) == pytest.approx(tuple(want), abs=1e-4)


def test_calibration_keeps_order_and_improves_brier(sample, spark, tmp_path):
    frame, _, _ = sample
    model = L.fit_logistic(frame, 1.0)
    before = score_summary(model.score(frame), by=[]).first()
    prefit = N.calibrate_fitted(model, frame)
    after = score_summary(prefit.score(frame), by=[]).first()
    assert after.roc_auc == pytest.approx(before.roc_auc) and after.brier <= before.brier
    folded = N.calibrate_folds(frame, lambda rows: L.fit_logistic(rows, 1.0), 3)
    assert len(folded.models) == 3
    assert score_summary(folded.score(frame), by=[]).first().brier <= before.brier
    write_model(spark, folded, str(tmp_path / "cal"))
    again = read_model(spark, str(tmp_path / "cal"))
    pair = folded.score(frame, "a").join(again.score(frame, "b").select("claim_id", "b"), "claim_id")
    assert pair.filter("abs(a - b) > 1e-12").count() == 0


def test_sweep_keeps_the_earliest_best(sample):
    frame, _, _ = sample
    _, best, table = L.sweep_logistic(frame, frame, grid=(0.01, 1.0))
    found = {r.c: r.pr_auc for r in table.collect()}
    assert set(found) == {0.01, 1.0} and found[best] == max(found.values())


def test_trees_votes_and_stacks_beat_chance(sample):
    frame, _, _ = sample
    small = P.Sizes(trees=3, rounds=3, folds=2)
    members = P.Members(small)
    models = {
        "forest": L.fit_forest(frame, trees=5, min_leaf=5), "early": L.fit_boosted_early(frame, frame, rounds=4, patience=3, start=2),
        "voting": P.voting(frame, small, members), "stacking": P.stacking(frame, small, members),
        "network": L.fit_network(frame, max_iter=20), "kernel": N.calibrate_fitted(L.fit_kernel_machine(frame, dims=64, max_iter=20), frame),
    }
    for name, model in models.items():
        scored = model.score(frame)
        assert scored.count() == 600, name
        assert scored.columns == ["claim_id", "label", "features", "prob"], name
        assert score_summary(scored, by=[]).first().roc_auc > 0.7, name


def test_chance_repeats_itself(sample):
    frame, _, y = sample
    model = L.fit_chance(frame)
    first, second = (model.score(frame).agg(F.sum("prob")).first()[0] for _ in range(2))
    assert first == second and 0 < first < 600


def test_patience():
    assert L.best_round([3, 2, 1, 2, 2, 2], 3) == (3, True)
    assert L.best_round([3, 2, 1, 2], 3) == (3, False)
    assert L.best_round([3, 2, 2.5, 1], 3) == (4, False)


def test_random_features_approach_the_kernel(sample):
    frame, x, _ = sample
    rows = L.random_features(frame, gamma=0.2, width=3, dims=4000).orderBy("claim_id").limit(40).collect()
    z = np.array([r.features.toArray() for r in rows])
    distance = ((x[:40, None] - x[None, :40]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-0.2 * distance)).max() < 0.1


def test_matrix(spark):
    rows = spark.createDataFrame([("1", "b", "u", 1.0, 5.0), ("2", "a", "u", 3.0, 5.0)], "claim_id string, k string, m string, x double, y double")
    matrix = fit_matrix(rows, categories=["k", "m"], numbers=["x", "y"])
    assert matrix.names == ["k_a", "k_b", "m_u", "x", "y"]
    later = spark.createDataFrame([("3", "new", None, 5.0, 6.0)], rows.schema)
    got = matrix.transform(rows.union(later)).orderBy("claim_id").collect()
    assert [r.features.toArray().tolist() for r in got] == [[0, 1, 1, -1, 0], [1, 0, 1, 1, 0], [0, 0, 0, 3, 1]]


def test_folds_are_exact_within_classes(spark, sample):
    frame, _, y = sample
    got = N.with_fold(frame.select("claim_id", "label"), 7).groupBy("label", "_fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in got if r["label"] == label]
        assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == (y == label).sum()


def test_cut_boosting_has_the_first_trees(sample):
    frame, _, _ = sample
    long, short = (L.fit_boosted(frame, rounds=n).model for n in (6, 4))
    assert [t.toDebugString.split("\n", 1)[1] for t in long.trees[:4]] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]


def test_composed_models_are_read_back(spark, sample, tmp_path):
    frame, _, _ = sample
    plain = L.fit_logistic(frame)
    inner = N.Voting([plain, L.fit_chance(frame)], [1, 3])
    stacked = N.fit_stacked(frame, [L.fit_logistic, L.fit_chance], 2)
    whole = N.Voting([inner, stacked, N.calibrate_folds(frame, L.fit_logistic, 2)], [1, 2, 1])
    write_model(spark, whole, str(tmp_path / "whole"))
    again = read_model(spark, str(tmp_path / "whole"))
    pair = whole.score(frame, "a").join(again.score(frame, "b").select("claim_id", "b"), "claim_id")
    assert pair.filter("abs(a - b) > 1e-12").count() == 0 and pair.columns == ["claim_id", "label", "features", "a", "b"]
    with pytest.raises(TypeError):
        write_model(spark, object(), str(tmp_path / "other"))
    with pytest.raises(Exception):
        write_model(spark, plain, str(tmp_path / "whole"))  # a folder is never written over


def test_registered_experiments_have_full_size(spark, sample, monkeypatch):
    """The suite, its predictions and stacking hand on the published sizes."""
    from riskledger.plans.catalog import models

    class Ended(Exception):
        pass

    used = []

    def recorder(real):
        def run(*args, **named):
            bound = inspect.signature(real).bind(*args, **named)
            bound.apply_defaults()
            used.append(bound.arguments["sizes"])
            raise Ended
        return run

    monkeypatch.setattr(P, "suite", recorder(P.suite))
    monkeypatch.setattr(P, "stacking", recorder(P.stacking))
    monkeypatch.setattr(models, "_claims", lambda *_: sample[0].withColumn(K.SPLIT, F.lit("train")))
    monkeypatch.setattr(models, "_sides", lambda *_: (sample[0], sample[0]))
    for name in ("ex_suite", "sc_experiment_predictions", "ml_stacking"):
        with pytest.raises(Ended):
            entry.queries()[name](spark, "")
    assert used == [P.Sizes(200, 200, None, 500, 5)] * 3


def test_early_boosting_is_cut_out_of_its_fit(spark, sample, tmp_path, monkeypatch):
    """No round is fitted a second time for the trees that are kept; the cut model equals a fit of so many rounds."""
    frame, _, _ = sample
    sizes, real = [], L.fit_boosted
    monkeypatch.setattr(L, "fit_boosted", lambda rows, rounds, **options: sizes.append(rounds) or real(rows, rounds, **options))
    monkeypatch.setattr(L, "best_round", lambda losses, patience: (3, True))
    cut = L.fit_boosted_early(frame, frame, rounds=6, start=6)
    assert sizes == [6] and cut.model.getNumTrees == 3
    write_model(spark, cut, str(tmp_path / "cut"))
    for model in (cut, read_model(spark, str(tmp_path / "cut"))):
        pair = model.score(frame, "a").join(real(frame, 3).score(frame, "b").select("claim_id", "b"), "claim_id")
        assert pair.filter("abs(a - b) > 1e-12").count() == 0


def test_learners_get_a_partition_per_core_at_most(spark):
    """A task of a forest hands on the sums of all open nodes, so partitions do not grow with the rows until they are large."""
    from riskledger.workspace import compact

    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1_000_000, numPartitions=64)
    assert compact(many).rdd.getNumPartitions() == cores
    assert compact(many, most_rows=50_000).rdd.getNumPartitions() == max(20, cores)
    assert compact(spark.range(100, numPartitions=64)).rdd.getNumPartitions() == 1


def test_mapped_rows_are_kept_once_and_by_one_fit_at_a_time(sample, monkeypatch):
    """The kernel machine keeps no copy of its mapped rows beside the learner's blocks, and folds do not overlap."""
    import threading

    frame, _, _ = sample
    real, mapped = L.random_features, []
    monkeypatch.setattr(L, "random_features", lambda *a: mapped.append(real(*a)) or mapped[-1])
    kept = []
    monkeypatch.setattr(type(frame), "persist", lambda df, *a: kept.append(df) or df)
    L.fit_kernel_machine(frame, dims=16, max_iter=3)
    assert mapped and not any(df is m for df in kept for m in mapped)
    lock, overlaps = threading.Lock(), []

    def fit(rows):
        overlaps.append(not lock.acquire(blocking=False))
        threading.Event().wait(0.2)
        lock.release()

    N.side_by_side([lambda: N.one_at_a_time(fit)(None)] * 3)
    assert overlaps == [False] * 3


def test_penalties_share_few_passes(sample, monkeypatch):
    """All penalties of a grid are fitted together, in about as many passes as Newton steps."""
    frame, x, y = sample
    passes, real = [], S.total
    monkeypatch.setattr(S, "total", lambda *a: passes.append(1) or real(*a))
    grid = (0.01, 0.1, 1.0, 10.0)
    models = [m.model for m in L.fit_logistics(frame, grid, None)]
    assert len(passes) <= 10
    for c, model in zip(grid, models):
        assert np.append(model.coefficients.toArray(), model.intercept) == pytest.approx(newton(x, y, np.ones(600), c), abs=1e-8)


def test_logistic_with_constant_columns_one_class_and_blocks(spark):
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(size=9000), np.ones(9000), np.zeros(9000)]
    y = (x[:, 0] + rng.normal(size=9000) > 1).astype(int)
    frame = spark.createDataFrame([(int(k), Vectors.dense(v)) for v, k in zip(x, y)], ["label", "features"]).repartition(1)
    model = L.fit_logistic(frame, 1.0, None).model
    b = newton(x[:, :1], y, np.ones(9000), 1.0)
    assert np.append(model.coefficients.toArray(), model.intercept) == pytest.approx([b[0], 0, 0, b[1]], abs=1e-6)
    assert L.fit_logistic(frame.filter("label = 0"), 1.0, None).score(frame).agg(F.max("prob")).first()[0] < 1e-6


def test_network_slopes_and_steps(sample, monkeypatch):
    """Slopes equal differences of Spark's own loss, a step takes little more than one pass, and all rows are in every pass."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    frame, x, y = sample
    layers, weight = [3, 4, 2], np.ones(600)
    learner = MultilayerPerceptronClassifier(layers=layers, maxIter=0, seed=2, blockSize=1)
    start = learner.fit(frame)
    flat = start.weights.toArray()
    found = S._network_sums(flat, layers)(x, y, weight) / 600
    assert found[1] == pytest.approx(start.summary().objectiveHistory[0])
    for i in range(len(flat)):
        near = np.eye(len(flat))[i] * 1e-5
        up, down = (S._network_sums(flat + d, layers)(x, y, weight)[1] / 600 for d in (near, -near))
        assert found[2 + i] == pytest.approx((up - down) / 2e-5, abs=1e-7)
    passes, real = [], S.total
    monkeypatch.setattr(S, "total", lambda *a: passes.append(real(*a)) or passes[-1])
    model = L.fit_network(frame, (4,), 15, 2).model
    assert 15 <= len(passes) <= 30 and all(p[0] == 600 for p in passes)
    spark_way = MultilayerPerceptronClassifier(layers=layers, maxIter=15, seed=2).fit(frame).summary().objectiveHistory[-1]
    mine = S._network_sums(model.weights.toArray(), layers)(x, y, weight)[1] / 600
    assert mine < found[1] and mine == pytest.approx(spark_way, rel=0.1)


def test_learners_get_a_partition_per_core_of_few_files(spark, tmp_path):
    """Small files are read several to a partition; learners' rows are spread over all cores nonetheless."""
    from riskledger.workspace import compact

    cores = spark.sparkContext.defaultParallelism
    spark.range(100_000).repartition(cores + cores // 2).write.parquet(str(tmp_path / "few"))
    few = spark.read.parquet(str(tmp_path / "few"))
    assert few.rdd.getNumPartitions() < cores
    assert compact(few).rdd.getNumPartitions() == cores
