"""Ranking and probability metrics over (label, score) rows.

Every metric that depends on the order of scores comes from one *score curve*: rows are first added
up per distinct score (combined before the shuffle, so a score shared by a third of all rows costs
one row per map task), then running totals are taken inside balanced score ranges and shifted by the
totals of the ranges above.  No window spans the whole table, and many models are evaluated at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators.ordering import global_rank, score_splits, with_bucket
from riskledger.workspace import stage_table


def score_curve(df: DataFrame, by: Sequence[str] = (), score: str = "prob", label: str = "label") -> DataFrame:
    """One row per distinct score (and group): rows, positives and their running totals from the top.

    Columns: the group columns, ``score``, ``n``, ``pos``, ``cum_n``, ``cum_pos`` (this score and all
    higher ones) and the group totals ``total_n``, ``total_pos``.
    """
    rows = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("_y"))
    splits = score_splits(rows, "score")
    per_score = (
        with_bucket(rows, "score", splits, "_range")
        .groupBy(*by, "_range", "score")
        .agg(F.count("*").alias("n"), F.sum("_y").alias("pos"))
    )
    # Totals per score range: at most (groups x ranges) rows, added up from the combined rows, so
    # their shuffle is reused.
    per_range = per_score.groupBy(*by, "_range").agg(F.sum("n").alias("_rn"), F.sum("pos").alias("_rp"))
    above = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = per_range.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(by)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_rn").over(above), F.lit(0)).alias("_above_n"),
        F.coalesce(F.sum("_rp").over(above), F.lit(0)).alias("_above_p"),
        F.sum("_rn").over(whole).alias("total_n"),
        F.sum("_rp").over(whole).alias("total_pos"),
    )
    match = F.col("_range") == F.col("_r")
    for i, g in enumerate(by):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = per_score.withColumns({
        "_in_n": F.sum("n").over(inside),
        "_in_p": F.sum("pos").over(inside),
    })
    return running.join(F.broadcast(shifts), match).select(
        *by,
        "score",
        "n",
        "pos",
        (F.col("_in_n") + F.col("_above_n")).alias("cum_n"),
        (F.col("_in_p") + F.col("_above_p")).alias("cum_pos"),
        "total_n",
        "total_pos",
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _summaries(curve: DataFrame, by: Sequence[str], k_frac: float, threshold: float | None, share: float) -> DataFrame:
    """One row per group with every order-dependent figure except the resolution of a tied cut-off."""
    n, pos, cum_n, cum_pos = (F.col(c) for c in ("n", "pos", "cum_n", "cum_pos"))
    total, hits, score = F.col("total_n"), F.col("total_pos"), F.col("score")
    k = F.greatest(F.lit(1), F.floor(total * F.lit(float(k_frac)))).cast("long")
    at_cut = (cum_n - n < k) & (k <= cum_n)
    # Linear interpolation between the two order statistics around the asked share.
    place = (total - 1) * F.lit(float(share))
    lower, upper = F.floor(place), F.ceil(place)
    below = total - cum_n

    def covers(index: Column) -> Column:
        return (below <= index) & (index < below + n)

    def pick(condition: Column, value: Column) -> Column:
        return F.max(F.when(condition, value))

    facts = curve.groupBy(*by).agg(
        F.max(total).alias("total_n"),
        F.max(hits).alias("total_pos"),
        (F.sum(F.try_divide(pos * cum_pos, cum_n)) / F.nullif(F.max(hits), F.lit(0))).alias("pr_auc"),
        F.try_divide(
            F.sum((n - pos) * (cum_pos - pos / 2)),
            F.max(hits) * (F.max(total) - F.max(hits)),
        ).alias("roc_auc"),
        (F.sum(pos * F.pow(score - 1, 2) + (n - pos) * F.pow(score, 2)) / F.max(total)).alias("brier"),
        F.max(k).alias("k"),
        pick(at_cut, score).alias("cut_score"),
        pick(at_cut, cum_pos - pos).alias("cut_pos_above"),
        pick(at_cut, k - (cum_n - n)).alias("cut_need"),
        pick(at_cut, n).alias("cut_n"),
        pick(at_cut, pos).alias("cut_pos"),
        F.max(place - lower).alias("_t"),
        pick(covers(lower), score).alias("_lo"),
        pick(covers(upper), score).alias("_hi"),
        pick(covers(lower), cum_n).alias("_lo_n"),
        pick(covers(lower), cum_pos).alias("_lo_p"),
        pick(covers(upper), cum_n).alias("_hi_n"),
        pick(covers(upper), cum_pos).alias("_hi_p"),
        *([] if threshold is None else [
            F.coalesce(pick(score >= F.lit(float(threshold)), cum_n), F.lit(0)).alias("_set_n"),
            F.coalesce(pick(score >= F.lit(float(threshold)), cum_pos), F.lit(0)).alias("_set_p"),
        ]),
    )
    if threshold is None:
        cut = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_t")
        on_lower = cut <= F.col("_lo")
        flagged = F.when(on_lower, F.col("_lo_n")).otherwise(F.col("_hi_n"))
        caught = F.when(on_lower, F.col("_lo_p")).otherwise(F.col("_hi_p"))
    else:
        cut, flagged, caught = F.lit(float(threshold)), F.col("_set_n"), F.col("_set_p")
    facts = facts.withColumns({"binary_threshold": cut, "tp": caught, "fp": flagged - caught})
    facts = facts.withColumns({
        "fn": F.col("total_pos") - F.col("tp"),
        "tn": F.col("total_n") - F.col("total_pos") - F.col("fp"),
        # With all or none of the tied rows positive, or all of them inside, their order is irrelevant.
        "tie_open": (F.col("cut_need") < F.col("cut_n")) & (F.col("cut_pos") > 0) & (F.col("cut_pos") < F.col("cut_n")),
        "cut_caught": F.when(F.col("cut_pos") == F.col("cut_n"), F.col("cut_need"))
        .when(F.col("cut_need") == F.col("cut_n"), F.col("cut_pos"))
        .otherwise(F.lit(0)),
    })
    return facts.drop("_t", "_lo", "_hi", "_lo_n", "_lo_p", "_hi_n", "_hi_p", "_set_n", "_set_p")


def _settle_ties(facts: DataFrame, df: DataFrame, by: Sequence[str], score: str, label: str, key: str) -> DataFrame:
    """Positives among the first ``cut_need`` tied rows in id order, for groups that need it."""
    marks = facts.filter("tie_open").select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(by)], "cut_score", "cut_need"
    )
    match = F.col(score).cast("double") == F.col("cut_score")
    for i, g in enumerate(by):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    # One row per model is broadcast; the tied rows themselves may be any share of the table.
    tied = df.join(F.broadcast(marks), match).select(
        *[f"_g{i}" for i in range(len(by))], key, F.col(label).cast("long").alias("_y"), "cut_need"
    )
    ranked = global_rank(tied, [F.col(key)], within=[f"_g{i}" for i in range(len(by))], rank="_at")
    first = ranked.filter(F.col("_at") <= F.col("cut_need"))
    caught = first.groupBy(*[f"_g{i}" for i in range(len(by))]).agg(F.sum("_y").alias("_settled"))
    on = F.lit(True)
    for i, g in enumerate(by):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = facts.join(F.broadcast(caught), on, "left")
    return joined.withColumn(
        "cut_caught", F.when(F.col("tie_open"), F.col("_settled")).otherwise(F.col("cut_caught"))
    ).select(*facts.columns)


def score_summary(
    df: DataFrame,
    by: Sequence[str] = ("model",),
    score: str = "prob",
    label: str = "label",
    key: str = K.KEY,
    k_frac: float = K.REVIEW_CAPACITY,
    threshold: float | None = None,
    share: float = 0.75,
) -> DataFrame:
    """Unrounded figures, one row per group.

    The curve is reduced to one row per group and written, so that checking whether a cut-off falls
    into a group of equal scores does not compute it twice.  Equal scores rank by ``key``.  Rows
    without a label are left out; a missing score fails the job.
    """
    by = list(by)
    # The scores are read for the quantiles and again for the curve, so they are computed once and
    # written with only the columns needed.  There is no filter on the score itself: it would be
    # pushed below the projection that computes the score and evaluate the whole model twice.
    needed = list(dict.fromkeys([*by, *([key] if key in df.columns else []), score, label]))
    scored = stage_table(df.filter(F.col(label).isNotNull()).select(*needed), "scores")
    facts = stage_table(_summaries(score_curve(scored, by, score, label), by, k_frac, threshold, share), "summary")
    if not facts.filter("tie_open").limit(1).isEmpty():
        facts = _settle_ties(facts, scored, by, score, label, key)
    caught = F.col("cut_pos_above") + F.col("cut_caught")
    return facts.select(
        *by,
        "total_n",
        "total_pos",
        "k",
        caught.alias("captured"),
        _ratio(caught, F.col("total_pos")).alias("capture_at_k"),
        _ratio(caught, F.col("k")).alias("precision_at_k"),
        "pr_auc",
        "roc_auc",
        "brier",
        "binary_threshold",
        "tn",
        "fp",
        "fn",
        "tp",
    )


def evaluate(
    df: DataFrame,
    by: Sequence[str] = ("model",),
    score: str = "prob",
    label: str = "label",
    key: str = K.KEY,
    k_frac: float = K.REVIEW_CAPACITY,
    binary_threshold: float | None = None,
) -> DataFrame:
    """The full metric set, one rounded row per model.

    Without ``binary_threshold`` the 75th percentile of the model's own scores is used.
    """
    s = score_summary(df, by, score, label, key, k_frac, binary_threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    four = lambda value: F.round(value, 4)
    return s.select(
        *by,
        four(F.col("roc_auc")).alias("roc_auc"),
        four(F.col("pr_auc")).alias("pr_auc"),
        four(F.col("brier")).alias("brier"),
        four(F.col("capture_at_k")).alias("capture_at_25"),
        four(F.col("precision_at_k")).alias("precision_at_25"),
        F.round("binary_threshold", 6).alias("binary_threshold"),
        four(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        four(_ratio(tp, tp + fp)).alias("precision"),
        four(_ratio(tp, tp + fn)).alias("recall"),
        F.array(F.array(tn, fp), F.array(fn, tp)).alias("confusion"),
    )


def brier(df: DataFrame, by: Sequence[str] = (), score: str = "prob", label: str = "label") -> DataFrame:
    """Mean squared distance between score and label."""
    return df.groupBy(*by).agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def calibration_gain(df: DataFrame, before: str, after: str, label: str = "label") -> DataFrame:
    """Brier score of two score columns and their difference."""
    gap = lambda c: F.avg(F.pow(F.col(c) - F.col(label), 2))
    return df.agg(gap(before).alias("brier_before"), gap(after).alias("brier_after")).withColumn(
        "gain", F.col("brier_before") - F.col("brier_after")
    )


def confusion(df: DataFrame, threshold: float | Column, by: Sequence[str] = (), score: str = "prob", label: str = "label") -> DataFrame:
    """The four counts at ``score >= threshold``."""
    flagged = F.col(score) >= threshold
    positive = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~positive & ~flagged).alias("tn"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
        F.count_if(positive & flagged).alias("tp"),
    )


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; 0 where a denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    })


def select_model(captures: DataFrame, preferred: str = "Cal-LR", tolerance: float = 1e-9) -> DataFrame:
    """The model with the best capture; among ties the preferred one, else the first by ``position``.

    ``captures`` holds one row per model: ``model``, ``capture`` and ``position``.
    """
    best = captures.agg(F.max("capture").alias("_best"))
    tied = captures.crossJoin(F.broadcast(best)).filter(F.col("_best") - F.col("capture") < tolerance)
    first = F.struct((F.col("model") != preferred).alias("_other"), "position")
    return tied.agg(
        F.min_by("model", first).alias("best_model"),
        F.max("_best").alias("best_capture"),
        F.count("*").alias("tied"),
    )


def prediction_totals(scored: DataFrame) -> DataFrame:
    """Rows and predicted positives per tier."""
    return scored.groupBy("risk_tier").agg(
        F.count("*").alias("claims"), F.sum("predicted_denial").alias("predicted_denials")
    )
