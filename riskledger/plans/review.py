"""From claims to a ranked, tiered and explained review list."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import add_features, take_split
from riskledger.operators import attribution as A
from riskledger.operators.ensembles import Calibrated, calibrate_folds
from riskledger.operators.explain import explain
from riskledger.operators.learners import Fitted, fit_logistic, score_many, sweep_logistic
from riskledger.operators.matrix import Matrix, fit_matrix
from riskledger.operators.metrics import calibration_gain, evaluate, score_summary
from riskledger.operators.order_statistics import percentile
from riskledger.operators.scoring import Scorecard, rank_and_tier
from riskledger.workspace import partition_count


def score_with_card(claims: DataFrame, card: Scorecard, keep: Sequence[str] = ()) -> DataFrame:
    """Id, probability and risk factors per claim, in one row-local stage.

    Factors are worked out before the claims are ranked, so the sort moves a few short columns
    instead of the whole feature row.
    """
    scored = card.score(add_features(claims), "denial_probability")
    factors = A.ordered_factors(F.col("denial_probability"), F.col("contributions"), card.names)
    return scored.select(K.KEY, *keep, "denial_probability", factors.alias("factors"))


def card_threshold(history: DataFrame, card: Scorecard) -> float:
    """75th percentile of the card's probabilities on the validation claims."""
    labelled_rows = take_split(history, "validation").filter(F.col(K.TARGET).isNotNull())
    return percentile(card.score(add_features(labelled_rows), "prob"), "prob", 0.75).first()["value"]


def publish(explained: DataFrame) -> DataFrame:
    """Rank and the six published columns."""
    return explained.select(
        "rank",
        K.KEY,
        "denial_probability",
        "predicted_denial",
        "risk_tier",
        A.factor_text(F.col("factors")).alias("top_risk_factors"),
        "explanation",
    )


def review_list(
    current: DataFrame,
    card: Scorecard,
    threshold: float,
    completion: Callable | None = None,
    completions: DataFrame | None = None,
) -> DataFrame:
    """The explained review list, one row per current claim, with its audit inputs."""
    tiered = rank_and_tier(score_with_card(current, card), threshold)
    return explain(tiered, completion=completion, completions=completions)


# --- fitted models ------------------------------------------------------------------------------

@dataclass
class Trained:
    """Everything the production step fits, and the figures it reports."""

    matrix: Matrix
    plain: Fitted
    calibrated: Calibrated
    threshold: float
    best_c: float
    metrics: dict


def labelled(df: DataFrame, matrix: Matrix) -> DataFrame:
    """Id, label and features: what learners read.

    Rows are spread by id over the shuffle partitions, whatever the size.
    """
    rows = matrix.transform(df).select(K.KEY, F.col(K.TARGET).alias("label"), "features")
    return rows.repartition(partition_count(df.sparkSession), K.KEY)


def train(
    history: DataFrame,
    grid: Sequence[float] = K.C_GRID,
    eval_folds: int = 3,
    final_folds: int = 5,
) -> Trained:
    """Choose the penalty on validation claims, report on test claims, refit on all history.

    ``plain`` (for attribution) and ``calibrated`` (for probabilities) are fitted on all history with
    a matrix refitted there; the decision threshold stays the one frozen on validation claims.
    """
    features = add_features(history).persist()
    train_rows, validation_rows = (take_split(features, s) for s in ("train", "validation"))
    matrix = fit_matrix(train_rows)
    held = {s: labelled(take_split(features, s), matrix).persist() for s in K.SPLITS}
    full = None
    try:
        plain, best_c, _ = sweep_logistic(held["train"], held["validation"], grid)
        fit = lambda rows: fit_logistic(rows, best_c)
        calibrated = calibrate_folds(held["train"], fit, eval_folds)
        on_validation = calibrated.score(held["validation"])
        threshold = score_summary(on_validation, by=[]).first()["binary_threshold"]
        report = evaluate(calibrated.score(held["test"]), by=[], binary_threshold=threshold).first().asDict()
        gain = calibration_gain(plain.score(on_validation, "raw"), "raw", "prob").first().asDict()

        full_matrix = fit_matrix(features)
        full = labelled(features, full_matrix).persist()
        final = fit(full)
        final_calibrated = calibrate_folds(full, fit, final_folds)
    finally:
        for part in [features, *held.values(), *([full] if full is not None else [])]:
            part.unpersist()
    return Trained(full_matrix, final, final_calibrated, threshold, best_c, report | gain)


def score_current(current: DataFrame, trained: Trained) -> DataFrame:
    """Probability from the calibrated model, factors from the plain one."""
    rows = trained.matrix.transform(add_features(current)).select(K.KEY, "features")
    scored = trained.calibrated.score(rows, "denial_probability")
    contribs = A.contributions(F.col("features"), trained.plain.model.coefficients.toArray().tolist())
    factors = A.ordered_factors(F.col("denial_probability"), contribs, trained.matrix.names)
    return scored.select(K.KEY, "denial_probability", factors.alias("factors"))


def metrics_document(trained: Trained, high_rows: int, completion_model: str) -> dict:
    """The published figures of one production run."""
    return figures_document(trained.metrics, trained.best_c, trained.threshold, high_rows, completion_model)


def figures_document(m: Mapping, best_c: float, threshold: float, high_rows: int, completion_model: str) -> dict:
    """The published figures from those of the test claims and of the calibration."""
    return {
        "model": "Calibrated LR",
        "best_C": best_c,
        "test_roc_auc": m["roc_auc"],
        "test_pr_auc": m["pr_auc"],
        "test_brier": m["brier"],
        "test_capture_at_25": m["capture_at_25"],
        "test_precision_at_25": m["precision_at_25"],
        "test_f1": m["f1"],
        "val_threshold": threshold,
        "brier_pre_calibration": round(m["brier_before"], 4),
        "brier_post_calibration": round(m["brier_after"], 4),
        "high_tier_count": high_rows,
        "llm_model": completion_model,
    }
