import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskledger.operators import metrics as M
from riskledger.operators.ordering import global_rank, order_breaks


def frame(spark, labels, scores):
    rows = [(f"{i:06d}", int(y), float(p)) for i, (y, p) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "claim_id string, label int, prob double")


def summary(spark, labels, scores, **options):
    return M.score_summary(frame(spark, labels, scores), by=[], **options).first()


FALLING = [0.9, 0.8, 0.3, 0.2, 0.1, 0.1, 0.1, 0.1]


@pytest.mark.parametrize("labels, scores, share, expected", [
    ([1, 1, 0, 0, 0, 0, 0, 0], FALLING, 0.25, 1.0),
    ([1, 1, 0, 0, 0, 0, 0, 0], [0.1, 0.1, 0.9, 0.8, 0.3, 0.2, 0.1, 0.1], 0.25, 0.0),
    ([0, 0, 0, 0], [0.9, 0.8, 0.7, 0.6], 0.25, 0.0),
    ([1, 1, 1, 1], [0.9, 0.8, 0.7, 0.6], 0.25, 0.25),
    ([1, 1, 1, 1], [0.9, 0.8, 0.7, 0.6], 1.0, 1.0),
])
def test_capture(spark, labels, scores, share, expected):
    assert summary(spark, labels, scores, k_frac=share).capture_at_k == expected


def test_precision_at_k(spark):
    assert summary(spark, [1, 1, 0, 0], [0.9, 0.8, 0.2, 0.1], k_frac=0.5).precision_at_k == 1.0
    assert summary(spark, [], []).precision_at_k == 0.0


def test_average_precision_of_perfect_order(spark):
    assert summary(spark, [0, 1], [0.1, 0.9]).pr_auc == 1.0


def test_evaluate_columns(spark):
    row = M.evaluate(frame(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), by=[]).first()
    assert set(row.asDict()) == {
        "roc_auc", "pr_auc", "brier", "capture_at_25", "precision_at_25", "binary_threshold", "f1", "precision", "recall", "confusion",
    }
    assert row.binary_threshold == pytest.approx(0.825) and row.roc_auc == 1.0
    assert row.confusion == [[2, 0], [1, 1]]


def expected(labels, scores, ids, share=0.25):
    """The same figures by brute force."""
    order = np.lexsort((ids, -scores))
    y, p = labels[order], scores[order]
    k = max(1, int(np.floor(len(y) * share)))
    positives = y.sum()
    points, hits, area = sorted(set(p), reverse=True), 0, 0.0
    for s in points:
        here = y[p == s].sum()
        hits += here
        area += here / positives * hits / (p >= s).sum()
    wins = sum((p[y == 0] < v).sum() + 0.5 * (p[y == 0] == v).sum() for v in p[y == 1])
    return y[:k].sum() / positives, area, wins / (positives * (len(y) - positives)), np.percentile(p, 75)


@pytest.mark.parametrize("digits", [None, 2, 1, 0])
def test_against_brute_force(spark, digits):
    rng = np.random.default_rng(7)
    labels = (rng.random(3000) < 0.3).astype(int)
    scores = np.clip(rng.random(3000) * 0.7 + labels * 0.2, 0, 1)
    if digits is not None:
        scores = np.round(scores, digits)
        scores[:1000] = 0.7 if digits else 1.0  # a third of all rows share one score
    got = summary(spark, labels, scores)
    want = expected(labels, scores, np.arange(3000))
    assert (got.capture_at_k, got.pr_auc, got.roc_auc, got.binary_threshold) == pytest.approx(want, abs=1e-12)
    assert got.tn + got.fp + got.fn + got.tp == 3000
    assert got.tp + got.fp == (scores >= want[3]).sum()


def test_given_threshold(spark):
    row = summary(spark, [0, 1, 0, 1], [0.2, 0.4, 0.6, 0.8], threshold=0.5)
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)
    assert summary(spark, [0, 1], [0.2, 0.4], threshold=0.9).tp == 0


def test_zero_division_is_zero(spark):
    counts = M.confusion(frame(spark, [0, 0], [0.1, 0.2]), 0.5)
    row = M.threshold_metrics(counts).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_model_choice_prefers_the_calibrated_one_only_in_a_tie(spark):
    columns = "model string, capture double, position int"
    tie = spark.createDataFrame([("LR", 0.5, 0), ("Cal-LR", 0.5, 1), ("RF", 0.4, 2)], columns)
    lead = spark.createDataFrame([("LR", 0.6, 0), ("Cal-LR", 0.5, 1), ("RF", 0.6, 2)], columns)
    assert M.select_model(tie).first().best_model == "Cal-LR"
    assert M.select_model(lead).first().best_model == "LR"


def test_global_rank_with_a_hot_score(spark):
    rows = spark.range(20000).select(
        F.format_string("C%06d", F.col("id")).alias("claim_id"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 1000) / 1000).alias("p"),
        (F.col("id") % 2).alias("g"),
    )
    ranked = global_rank(rows, [F.desc("p"), F.asc("claim_id")], total="n")
    single = Window.orderBy(F.desc("p"), "claim_id")
    assert ranked.withColumn("x", F.row_number().over(single)).filter("x <> rank or n <> 20000").count() == 0
    within = global_rank(rows, [F.desc("p"), F.asc("claim_id")], within=["g"])
    per_group = Window.partitionBy("g").orderBy(F.desc("p"), "claim_id")
    assert within.withColumn("x", F.row_number().over(per_group)).filter("x <> rank").count() == 0
    # The hot score is spread over several sort partitions, and no step gathers all rows in one task.
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "claim_id" not in "".join(line for line in plan.splitlines() if "SinglePartition" in line)


def test_order_breaks_across_buckets(spark):
    good = spark.range(1, 101).select(F.col("id").alias("rank"), (1 / F.col("id")).alias("p"))
    assert order_breaks(good, "rank", "p", rows_per_bucket=10).first().breaks == 0
    edge = good.withColumn("p", F.when(F.col("rank") == 11, 0.95).otherwise(F.col("p")))
    inner = good.withColumn("p", F.when(F.col("rank") == 15, 0.95).otherwise(F.col("p")))
    assert order_breaks(edge, "rank", "p", rows_per_bucket=10).first().breaks == 1
    assert order_breaks(inner, "rank", "p", rows_per_bucket=10).first().breaks == 1
