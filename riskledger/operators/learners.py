"""Classifiers.  Each ``fit_*`` takes a frame with ``features``, ``label`` and the claim id.

Fitted objects share one method, ``score(df, out)``, that adds a probability column, so single
models, calibrated models and ensembles can replace each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators.metrics import score_summary
from riskledger.operators.passes import NETWORK_KIND, fit_network_weights, newton_logistic, packed
from riskledger.operators.trees import Boosting, boosted_together, forest_trees, tree_model
from riskledger.workspace import stage_table


class Scorer(Protocol):
    def score(self, df: DataFrame, out: str = "prob") -> DataFrame: ...


@dataclass
class Fitted:
    """A Spark ML classification model; ``margin`` is the raw score of the positive class."""

    model: Any

    def _bare(self, df: DataFrame, column: str, out: str) -> DataFrame:
        have = df.columns
        scored = self.model.transform(df.drop("rawPrediction", "probability", "prediction"))
        return scored.select(*[c for c in have if c != out], vector_to_array(F.col(column))[1].alias(out))

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        return self._bare(df, "probability", out)

    def margin(self, df: DataFrame, out: str = "margin") -> DataFrame:
        return self._bare(df, "rawPrediction", out)


# --- class weights ------------------------------------------------------------------------------

def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("_n"), F.count("*").alias("_k"))
    return counts.crossJoin(F.broadcast(whole)).select(
        label, "n", (F.col("_n") / (F.col("_k") * F.col("n"))).alias("weight")
    )


def weight_table(df: DataFrame, weights: str | Mapping[int, float] | None) -> tuple[dict[int, float], dict[int, int]]:
    """Weight and rows per class.  ``weights`` is ``"balanced"``, a weight per class, or ``None``.  Only the class counts are fetched."""
    counts = {int(r["label"]): r["count"] for r in df.groupBy("label").count().collect()}
    rows = sum(counts.values())
    if weights == "balanced":
        return {c: rows / (len(counts) * n) for c, n in counts.items()}, counts
    return {int(c): float(w) for c, w in dict(weights or {}).items()}, counts


def weighted(df: DataFrame, weights: str | Mapping[int, float] | None) -> tuple[DataFrame, float]:
    """Adds ``weight`` (see ``weight_table``) and returns it with the sum of weights."""
    table, counts = weight_table(df, weights)
    weight = F.lit(1.0)
    for c, w in table.items():
        weight = F.when(F.col("label") == int(c), F.lit(float(w))).otherwise(weight)
    return df.withColumn("weight", weight), float(sum(n * table.get(c, 1.0) for c, n in counts.items()))


# --- logistic regression ------------------------------------------------------------------------

def fit_logistic(df: DataFrame, c: float = 1.0, class_weight="balanced", max_iter: int = 1000, tol: float = 1e-6) -> Fitted:
    """L2 logistic regression with inverse regularisation strength ``c``.

    The penalty is stated per unit of weight: ``1 / (c * sum of weights)``.
    """
    return fit_logistics(df, [c], class_weight, max_iter, tol)[0]


def logistic_model(numbers: np.ndarray) -> LogisticRegressionModel:
    """The Spark ML model of given coefficients and, last, the intercept."""
    context = SparkSession.active().sparkContext
    kinds = context._jvm.org.apache.spark.ml
    values = context._gateway.new_array(context._jvm.double, len(numbers) - 1)
    for i, number in enumerate(numbers[:-1]):
        values[i] = float(number)
    name = f"logistic_{uuid4().hex[:12]}"
    return LogisticRegressionModel(kinds.classification.LogisticRegressionModel(name, kinds.linalg.DenseVector(values), float(numbers[-1])))


def fit_logistics(df: DataFrame, grid: Sequence[float], class_weight="balanced", max_iter: int = 1000, tol: float = 1e-6) -> list[Fitted]:
    """``fit_logistic`` for several ``c``: their Newton steps share the passes over the rows."""
    rows, total = weighted(df, class_weight)
    if rows.select("label").distinct().count() < 2:  # no finite intercept; Spark's learner has a rule for it
        learners = [LogisticRegression(weightCol="weight", regParam=1.0 / (c * total), standardization=False) for c in grid]
        return [Fitted(learner.fit(rows)) for learner in learners]
    with packed(rows) as blocks:
        found = newton_logistic(blocks, [1.0 / c for c in grid], max_iter, tol)
    return [Fitted(logistic_model(numbers)) for numbers in found]


def score_many(df: DataFrame, scorers: Mapping[str, Scorer], keep: Sequence[str]) -> DataFrame:
    """One row per input row and model (``model``, ``prob``), from one pass over ``df``."""
    wide = df
    for i, scorer in enumerate(scorers.values()):
        wide = scorer.score(wide, f"_p{i}")
    pairs = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prob")) for i, name in enumerate(scorers)
    ])
    return wide.select(*keep, F.inline(pairs))


def sweep_logistic(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[float] = K.C_GRID,
    class_weight="balanced",
    key: str = K.KEY,
) -> tuple[Fitted, float, DataFrame]:
    """Fit every ``c`` of the grid and keep the one with the best validation average precision.

    All candidates are scored and evaluated together.  Returns the model, its ``c`` and the table of
    ``(c, pr_auc)``; on equal values the earlier grid entry wins.
    """
    fitted = dict(zip(grid, fit_logistics(train, grid, class_weight)))
    names = {str(c): c for c in grid}
    scored = score_many(validation, {str(c): m for c, m in fitted.items()}, [key, "label"])
    table = score_summary(scored, by=["model"]).select(F.col("model").cast("double").alias("c"), "pr_auc")
    found = {r.c: r.pr_auc for r in table.collect()}  # one row per grid entry
    best = max(names.values(), key=lambda c: (found[c], -list(grid).index(c)))
    return fitted[best], best, table


# --- trees --------------------------------------------------------------------------------------

def fit_forest(df: DataFrame, trees: int = 200, depth: int = 12, min_leaf: int = 10, class_weight="balanced", seed: int = K.SEED) -> Fitted:
    table, _ = weight_table(df, class_weight)
    weights = table.get(0, 1.0), table.get(1, 1.0)
    grown, cuts = forest_trees(df, trees, depth, min_leaf, weights, seed)
    learner = RandomForestClassifier(numTrees=1, maxDepth=depth, minInstancesPerNode=min_leaf, weightCol="weight", seed=seed)
    return Fitted(tree_model(df, learner, grown, cuts, [1.0] * trees, {"numTrees": trees}))


def fit_boosted(df: DataFrame, seed: int = K.SEED, positive_weight: float = 1.0, **how: Any) -> Fitted:
    """Gradient-boosted trees; ``how`` are settings of ``Boosting``."""
    return fit_boosted_together(df, [boosting(positive_weight, **how)], seed)[0]


def boosting(positive_weight: float = 1.0, **how: Any) -> Boosting:
    return Boosting(weights=(1.0, positive_weight), **how)


def fit_boosted_together(df: DataFrame, fits: Sequence[Boosting], seed: int = K.SEED) -> list[Fitted]:
    """Gradient-boosted models that share their passes over the rows, each on all rows or on those outside of one ``_fold``."""
    found = []
    for how, (grown, cuts) in zip(fits, boosted_together(df, fits, seed)):
        learner = GBTClassifier(
            maxIter=1,
            maxDepth=how.depth,
            stepSize=how.step,
            subsamplingRate=how.row_share,
            featureSubsetStrategy="all" if how.column_share >= 1.0 else str(how.column_share),
            minInstancesPerNode=how.min_leaf,
            weightCol="weight",
            seed=seed,
        )
        found.append(Fitted(tree_model(df, learner, grown, cuts, [1.0] + [how.step] * (how.rounds - 1), {"maxIter": how.rounds})))
    return found


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest loss before ``patience`` rounds pass without a lower one.

    The flag tells whether the patience ran out within the given losses.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(fitted: Fitted, kept: int) -> Fitted:
    """The boosted model of the first ``kept`` trees: a fit of so many rounds has the same, as rounds are seeded one by one."""
    whole = fitted.model
    if kept == whole.getNumTrees:
        return fitted
    context, java = SparkSession.active().sparkContext, whole._java_obj
    kinds = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(kinds.regression.DecisionTreeRegressionModel, kept)
    weights = context._gateway.new_array(context._jvm.double, kept)
    for i, (tree, weight) in enumerate(zip(java.trees()[:kept], whole.treeWeights)):
        trees[i], weights[i] = tree, float(weight)
    cut = kinds.classification.GBTClassificationModel(f"{whole.uid}_{kept}", trees, weights, whole.numFeatures, whole.numClasses)
    return Fitted(GBTClassificationModel(cut))


def fit_boosted_early(df: DataFrame, validation: DataFrame, rounds: int = 300, patience: int = 30, start: int | None = None, **options) -> Fitted:
    """Boosting that keeps the rounds up to the lowest validation loss.

    It looks for a stretch of ``patience`` rounds without improvement among all ``rounds``, or first among ``start``
    where a model is expected to stop early.  The rounds kept are cut out of the fitted model, not fitted once more.
    """
    size = min(start or rounds, rounds)
    watched = validation.withColumn("weight", F.lit(1.0))
    while True:
        fitted = fit_boosted(df, rounds=size, **options)
        kept, stopped = best_round(fitted.model.evaluateEachIteration(watched), patience)
        if stopped or size >= rounds:
            return first_rounds(fitted, kept)
        size = rounds


# --- neural network and kernel machine ----------------------------------------------------------

def fit_network(df: DataFrame, hidden: Sequence[int] = (64, 32), max_iter: int = 500, seed: int = K.SEED) -> Fitted:
    """Feed-forward network of sigmoid units, fitted by quasi-Newton steps over all rows.

    Spark's learner draws the first weights and makes the model of the last ones, each from a single row and without a step.
    """
    width = df.select(F.size(vector_to_array(F.col("features")))).first()[0]
    layers = [width, *hidden, 2]
    few = stage_table(df.select("features", F.col("label").cast("double").alias("label")).limit(1), "network")
    bare = MultilayerPerceptronClassifier(layers=layers, maxIter=0, seed=seed)
    with packed(df.withColumn("weight", F.lit(1.0)), NETWORK_KIND) as blocks:
        weights, _ = fit_network_weights(blocks, layers, bare.fit(few).weights.toArray(), max_iter)
    return Fitted(bare.copy({bare.initialWeights: Vectors.dense(weights)}).fit(few))


def random_features(df: DataFrame, gamma: float, width: int, dims: int, seed: int = K.SEED) -> DataFrame:
    """Replaces ``features`` by random cosine features whose dot products approach the RBF kernel."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, np.sqrt(2.0 * gamma), (width, dims))
    offsets = rng.uniform(0.0, 2.0 * np.pi, dims)
    scale = np.sqrt(2.0 / dims)

    @F.pandas_udf("array<double>")
    def project(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(scale * np.cos(np.stack(values.to_numpy()) @ directions + offsets)))

    return df.withColumn("features", array_to_vector(project(vector_to_array(F.col("features")))))


@dataclass
class KernelMachine:
    """Linear support vector machine over random cosine features; only margins."""

    model: Any
    gamma: float
    width: int
    dims: int
    seed: int

    def margin(self, df: DataFrame, out: str = "margin") -> DataFrame:
        have = df.columns
        mapped = random_features(df.withColumn("_kept", F.col("features")), self.gamma, self.width, self.dims, self.seed)
        scored = Fitted(self.model).margin(mapped, out)
        restored = scored.withColumn("features", F.col("_kept"))
        return restored.select(*[c for c in have if c != out], out)


def kernel_scale(df: DataFrame) -> tuple[float, int]:
    """``1 / (width * variance of all matrix entries)`` and the width, from one aggregate."""
    cells = df.select(vector_to_array(F.col("features")).alias("v")).select(
        F.size("v").alias("w"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("q"),
    )
    row = cells.agg(F.max("w").alias("w"), F.sum("w").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    variance = row.q / row.n - (row.s / row.n) ** 2
    return 1.0 / (row.w * variance), int(row.w)


def fit_kernel_machine(df: DataFrame, c: float = 1.0, dims: int = 256, class_weight="balanced", max_iter: int = 100, seed: int = K.SEED) -> KernelMachine:
    gamma, width = kernel_scale(df)
    rows, total = weighted(df, class_weight)
    # The learner keeps the mapped rows itself, in blocks, while it steps: a second copy here would double the disk they take.
    mapped = random_features(rows, gamma, width, dims, seed)
    model = LinearSVC(weightCol="weight", regParam=1.0 / (c * total), standardization=False, maxIter=max_iter).fit(mapped)
    return KernelMachine(model, gamma, width, dims, seed)


# --- chance baseline ----------------------------------------------------------------------------

def id_uniform(key: str, seed: int) -> Column:
    """A number in [0, 1) fixed by the id, so a retried task draws the same value."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))


@dataclass
class Chance:
    """Answers 1 at the rate of positives in the training rows, whatever the features."""

    prior: float
    key: str = K.KEY
    seed: int = K.SEED

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        return df.withColumn(out, (id_uniform(self.key, self.seed) < F.lit(self.prior)).cast("double"))


def fit_chance(df: DataFrame, key: str = K.KEY, seed: int = K.SEED) -> Chance:
    return Chance(float(df.agg(F.avg("label")).first()[0]), key, seed)
