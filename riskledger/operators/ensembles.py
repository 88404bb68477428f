"""Calibration, voting and stacking: models built from other models' scores.

Rows of each class are numbered in the order of the md5 of their id, and a row's fold is its number modulo the folds:
class counts of two folds differ by one at most, and the same row is in the same fold on every run.  Scores of held-out
rows are written as soon as a fold's model is fitted, and the model is let go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from threading import BoundedSemaphore
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators.learners import Fitted, Scorer, fit_logistic
from riskledger.operators.ordering import global_rank
from riskledger.operators.passes import newton_logistic, packed
from riskledger.workspace import compact, fresh_path

FitFunction = Callable[[DataFrame], Any]
#: Independent jobs that one caller submits at a time, and fits of large tree models in flight in the whole process:
#: their nodes are kept by the driver.
THREADS = 8
_LARGE = BoundedSemaphore(3)
#: Fits in flight that keep wide mapped rows (2 kB each) for as long as they run.
_WIDE = BoundedSemaphore(1)


def one_of_few(fit: FitFunction) -> FitFunction:
    """``fit``, waiting while other fits of large models are in flight."""

    def run(rows: DataFrame) -> Any:
        with _LARGE:
            return fit(rows)

    return run


def one_at_a_time(fit: FitFunction) -> FitFunction:
    """``fit``, waiting while another fit that keeps wide rows is in flight: their blocks together would go to disk."""

    def run(rows: DataFrame) -> Any:
        with _WIDE:
            return fit(rows)

    return run


@dataclass(frozen=True)
class ByFolds:
    """A learner whose models of all folds are fitted together: ``outside`` gives, for rows with ``_fold``, the model of the
    rows outside of each fold in turn."""

    fit: FitFunction
    outside: Callable[[DataFrame], Sequence[Any]]

    def __call__(self, rows: DataFrame) -> Any:
        return self.fit(rows)


def side_by_side(jobs: Sequence[Callable[[], Any]], threads: int = THREADS) -> list[Any]:
    """Results of independent fits, in order.  Each is submitted by a driver thread; Spark runs their tasks together."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, min(threads, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def with_fold(df: DataFrame, folds: int, key: str = K.KEY, label: str = "label") -> DataFrame:
    """Adds ``_fold``, from exact numbers within each class; the rows are written once, in the order of the numbers."""
    placed = global_rank(df, [F.md5(F.col(key).cast("string")), F.col(key)], within=[label], rank="_place")
    return placed.withColumn("_fold", F.pmod(F.col("_place") - 1, F.lit(folds)).cast("int")).drop("_place")


# --- sigmoid calibration ------------------------------------------------------------------------

@dataclass(frozen=True)
class Sigmoid:
    slope: float
    offset: float

    def of(self, margin: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.slope) * margin + F.lit(self.offset))))


def fit_sigmoid(df: DataFrame, margin: str = "margin", label: str = "label") -> Sigmoid:
    """Sigmoid of the margin fitted to smoothed targets (Platt 1999).

    The positive target is (p + 1) / (p + 2) and the negative one 1 / (n + 2).
    """
    counts = {int(r[label]): r["count"] for r in df.groupBy(label).count().collect()}
    high = (counts.get(1, 0) + 1.0) / (counts.get(1, 0) + 2.0)
    low = 1.0 / (counts.get(0, 0) + 2.0)
    target = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    rows = df.select(array_to_vector(F.array(F.col(margin).cast("double"))).alias("features"), target.alias("label"), F.lit(1.0).alias("weight"))
    with packed(rows) as blocks:
        slope, offset = newton_logistic(blocks, [0.0], 200, 1e-10)[0]
    return Sigmoid(float(slope), float(offset))


@dataclass
class Calibrated:
    """Mean of the calibrated probabilities of one or more models with margins."""

    models: Sequence[Any]
    sigmoids: Sequence[Sigmoid]

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        wide = df
        for i, model in enumerate(self.models):
            wide = model.margin(wide, f"{out}_m{i}")  # named after ``out``, as members may be composed themselves
        parts = [s.of(F.col(f"{out}_m{i}")) for i, s in enumerate(self.sigmoids)]
        mean = reduce(lambda a, b: a + b, parts) / F.lit(float(len(parts)))
        return wide.withColumn(out, mean).drop(*[f"{out}_m{i}" for i in range(len(parts))])


def calibrate_fitted(model: Any, validation: DataFrame) -> Calibrated:
    """Sigmoid for an already fitted model, from rows it was not fitted on."""
    return Calibrated([model], [fit_sigmoid(model.margin(validation))])


def calibrate_folds(df: DataFrame, fit: FitFunction | None = None, folds: int = 3, key: str = K.KEY) -> Calibrated:
    """Per fold: fit on the other rows, calibrate on the fold; score with the mean of all folds.

    ``df`` should be persisted: it is read once per fold and optimiser step.
    """
    fit = fit or fit_logistic
    marked = compact(with_fold(df, folds, key))

    def one(fold: int) -> tuple[Any, Sigmoid]:
        model = fit(marked.filter(F.col("_fold") != fold).drop("_fold"))
        held = model.margin(marked.filter(F.col("_fold") == fold).drop("_fold")).persist()
        try:
            return model, fit_sigmoid(held)
        finally:
            held.unpersist()

    pairs = side_by_side([partial(one, fold) for fold in range(folds)])
    return Calibrated([m for m, _ in pairs], [s for _, s in pairs])


# --- voting -------------------------------------------------------------------------------------

def weighted_vote(scores: Sequence[Column], weights: Sequence[float]) -> Column:
    total = reduce(lambda a, b: a + b, [s * F.lit(float(w)) for s, w in zip(scores, weights)])
    return total / F.lit(float(sum(weights)))


@dataclass
class Voting:
    """Weighted mean of member probabilities, computed side by side on one frame."""

    members: Sequence[Scorer]
    weights: Sequence[float]

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        wide = df
        for i, member in enumerate(self.members):
            wide = member.score(wide, f"{out}_v{i}")
        names = [f"{out}_v{i}" for i in range(len(self.members))]
        return wide.withColumn(out, weighted_vote([F.col(n) for n in names], self.weights)).drop(*names)


# --- stacking -----------------------------------------------------------------------------------

@dataclass
class Stacked:
    """A final model over the members' probabilities followed by the original features."""

    members: Sequence[Scorer]
    final: Fitted

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        have = [c for c in df.columns if c != out]
        names, original = [f"{out}_s{i}" for i in range(len(self.members))], f"{out}_original"
        wide = df
        for name, member in zip(names, self.members):
            wide = member.score(wide, name)
        wide = wide.withColumnRenamed("features", original)
        wide = VectorAssembler(inputCols=[*names, original], outputCol="features").transform(wide).drop(*names)
        return self.final.score(wide, out).select(*[F.col(original).alias(c) if c == "features" else F.col(c) for c in have], out)


def fit_stacked(
    df: DataFrame,
    fits: Sequence[FitFunction],
    folds: int = 5,
    key: str = K.KEY,
    members: Callable[[], Sequence[Scorer]] | None = None,
    marked: DataFrame | None = None,
) -> Stacked:
    """Out-of-fold member probabilities train the final model; members are then fitted on all rows.

    Every pair of a fold and a member is a job of its own: it writes its held-out probabilities and lets its model go,
    so the driver holds the models in flight only.  The folds of a learner ``ByFolds`` are one job.  ``members`` may hand in
    models that are fitted on all of ``df``, and ``marked`` the rows of ``df`` with their ``_fold``.
    """
    spark = df.sparkSession
    marked = compact(with_fold(df, folds, key)) if marked is None else marked
    path = fresh_path(spark, "held-out")

    def held_out(fold: int, member: int, fitted: Any) -> None:
        scored = fitted.score(marked.filter(F.col("_fold") == fold).drop("_fold"), "prob")
        scored.select(key, "prob").write.parquet(f"{path}/fold={fold}/member={member}")

    def one_fold(fold: int, member: int) -> None:
        held_out(fold, member, fits[member](marked.filter(F.col("_fold") != fold).drop("_fold")))

    def all_folds(member: int) -> None:
        for fold, fitted in enumerate(fits[member].outside(marked)):
            held_out(fold, member, fitted)

    jobs = []
    for member in reversed(range(len(fits))):
        jobs += [partial(all_folds, member)] if isinstance(fits[member], ByFolds) else [partial(one_fold, fold, member) for fold in range(folds)]
    side_by_side(jobs)
    names = [f"_s{i}" for i in range(len(fits))]
    wide = spark.read.parquet(path).groupBy(key).agg(*[
        F.max(F.when(F.col("member") == i, F.col("prob"))).alias(name) for i, name in enumerate(names)
    ])
    rows = marked.drop("_fold").withColumnRenamed("features", "_original").join(wide, key)
    level_one = VectorAssembler(inputCols=[*names, "_original"], outputCol="features").transform(rows).select(key, "label", "features").persist()
    try:
        final = fit_logistic(level_one, c=1.0, class_weight=None)
    finally:
        level_one.unpersist()
    return Stacked(list(members()) if members else side_by_side([partial(fit, df) for fit in fits]), final)
