"""Queries: metrics, scoring, ranking, tiers and risk factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.wording import feature_name, friendly_label, label_array, ordered_label
from riskledger.operators import attribution as A
from riskledger.operators import metrics as M
from riskledger.operators import scoring as S
from riskledger.operators.ensembles import weighted_vote
from riskledger.operators.order_statistics import percentile
from riskledger.plans.catalog.base import (
    SCORECARD, add, card_scores, claims_from_orders, current_claims, features, history_claims, model_scores, quoted, tiered,
)
from riskledger.plans.review import card_threshold, score_with_card
from riskledger.sources.stores import write_metrics
from riskledger.workspace import fresh_path

# --- metrics ------------------------------------------------------------------------------------

_RANKED = """
SELECT model, label, row_number() OVER (PARTITION BY model ORDER BY prob DESC, claim_id) AS place,
  greatest(1, floor(count(*) OVER (PARTITION BY model) * 0.25e0)) AS k, sum(label) OVER (PARTITION BY model) AS positives FROM models
"""
_GROUPED = """
SELECT model, prob, n, pos, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos,
  sum(pos) OVER (PARTITION BY model) AS p, sum(n) OVER (PARTITION BY model) AS total
FROM (SELECT model, prob, count(*) AS n, sum(label) AS pos FROM models GROUP BY model, prob) AS g
WINDOW w AS (PARTITION BY model ORDER BY prob DESC)
"""
_AP = f"SELECT model, sum(pos * cum_pos / CAST(cum_n AS DOUBLE)) / max(p) AS pr_auc FROM ({_GROUPED}) AS c GROUP BY model"
_AUC = f"""SELECT model, (sum(pos * (2 * (total - cum_n) + n + 1) / 2e0) - max(p) * (max(p) + 1) / 2e0)
  / (max(p) * (max(total) - max(p))) AS roc_auc FROM ({_GROUPED}) AS c GROUP BY model"""
_TOP = f"""SELECT model, sum(label) FILTER (place <= k) AS caught, max(positives) AS positives, max(k) AS k FROM ({_RANKED}) AS r GROUP BY model"""
_CUTS = "SELECT model, quantile_cont(prob, 0.75) AS cut FROM models GROUP BY model"
_CONFUSION = f"""SELECT model, count(*) FILTER (label = 0 AND prob < cut) AS tn, count(*) FILTER (label = 0 AND prob >= cut) AS fp,
  count(*) FILTER (label = 1 AND prob < cut) AS fn, count(*) FILTER (label = 1 AND prob >= cut) AS tp, max(cut) AS cut
  FROM models JOIN ({_CUTS}) AS q USING (model) GROUP BY model"""


def _summary(column: str, name: str, digits: int = 9):
    def run(spark, folder) -> DataFrame:
        return M.score_summary(model_scores(spark, folder)).select("model", F.round(column, digits).alias(name))
    return run


add("mt_capture_at_k", _summary("capture_at_k", "capture_at_k"),
    f"SELECT model, round(caught / CAST(positives AS DOUBLE), 9) AS capture_at_k FROM ({_TOP}) AS t")
add("mt_precision_at_k", _summary("precision_at_k", "precision_at_k"),
    f"SELECT model, round(caught / CAST(k AS DOUBLE), 9) AS precision_at_k FROM ({_TOP}) AS t")
add("mt_pr_auc", _summary("pr_auc", "pr_auc"), f"SELECT model, round(pr_auc, 9) AS pr_auc FROM ({_AP}) AS t")
add("mt_roc_auc", _summary("roc_auc", "roc_auc"), f"SELECT model, round(roc_auc, 9) AS roc_auc FROM ({_AUC}) AS t")
add("mt_brier", lambda spark, folder: M.brier(model_scores(spark, folder), ["model"]).select("model", F.round("brier", 9).alias("brier")),
    "SELECT model, round(avg((prob - label) * (prob - label)), 9) AS brier FROM models GROUP BY model")
add("mt_threshold_p75", lambda spark, folder: percentile(model_scores(spark, folder), "prob", 0.75, ["model"], "threshold").withColumn(
    "threshold", F.round("threshold", 9)), f"SELECT model, round(cut, 9) AS threshold FROM ({_CUTS}) AS t")


def mt_confusion(spark, folder) -> DataFrame:
    return M.score_summary(model_scores(spark, folder)).select("model", "tn", "fp", "fn", "tp")


add("mt_confusion", mt_confusion, f"SELECT model, tn, fp, fn, tp FROM ({_CONFUSION}) AS t")


def _at_half(name: str):
    def run(spark, folder) -> DataFrame:
        counts = M.confusion(model_scores(spark, folder), 0.5, ["model"])
        return M.threshold_metrics(counts).select("model", F.round(name, 9).alias(name))
    return run


_HALF = """SELECT model, count(*) FILTER (label = 1 AND prob >= 0.5e0) AS tp, count(*) FILTER (label = 0 AND prob >= 0.5e0) AS fp,
  count(*) FILTER (label = 1 AND prob < 0.5e0) AS fn FROM models GROUP BY model"""
for _name, _formula in {
    "precision": "tp / CAST(nullif(tp + fp, 0) AS DOUBLE)",
    "recall": "tp / CAST(nullif(tp + fn, 0) AS DOUBLE)",
    "f1": "2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE)",
}.items():
    add(f"mt_{_name}", _at_half(_name), f"SELECT model, round(coalesce({_formula}, 0e0), 9) AS {_name} FROM ({_HALF}) AS t")


def mt_evaluate(spark, folder) -> DataFrame:
    full = M.evaluate(model_scores(spark, folder))
    cell = lambda i, j: F.col("confusion")[i][j]
    return full.select(
        *[c for c in full.columns if c != "confusion"],
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"),
    )


_EVALUATE_SQL = f"""
SELECT model, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(brier, 4) AS brier,
  round(caught / CAST(positives AS DOUBLE), 4) AS capture_at_25, round(caught / CAST(k AS DOUBLE), 4) AS precision_at_25,
  round(cut, 6) AS binary_threshold, round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 4) AS f1,
  round(tp / CAST(tp + fp AS DOUBLE), 4) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 4) AS recall, tn, fp, fn, tp
FROM ({_AUC}) AS a JOIN ({_AP}) AS b USING (model) JOIN ({_TOP}) AS c USING (model) JOIN ({_CONFUSION}) AS d USING (model)
JOIN (SELECT model, avg((prob - label) * (prob - label)) AS brier FROM models GROUP BY model) AS e USING (model)"""
add("mt_evaluate", mt_evaluate, _EVALUATE_SQL)
_DOCUMENT = ("model", "capture_at_25", "roc_auc", "pr_auc", "brier", "f1")


def io_write_metrics(spark, folder) -> DataFrame:
    """The evaluation of every model as one JSON document each, written and read back."""
    path = fresh_path(spark, "metrics")
    write_metrics(M.evaluate(model_scores(spark, folder)).select(*_DOCUMENT), path)
    return spark.read.schema("model string, " + ", ".join(f"{c} double" for c in _DOCUMENT[1:])).json(path)


add("io_write_metrics", io_write_metrics, f"SELECT {', '.join(_DOCUMENT)} FROM ({_EVALUATE_SQL}) AS doc")
def mt_calibration_gain(spark, folder) -> DataFrame:
    held = card_scores(spark, folder).filter(F.col(K.SPLIT) == "validation").withColumnRenamed(K.TARGET, "label")
    gain = M.calibration_gain(held, "raw_prob", "prob")
    return gain.select(*[F.round(c, 9).alias(c) for c in gain.columns])


add("mt_calibration_gain", mt_calibration_gain, """
SELECT round(a, 9) AS brier_before, round(b, 9) AS brier_after, round(a - b, 9) AS gain
FROM (SELECT avg(pow(raw_prob - is_denied, 2)) AS a, avg(pow(prob - is_denied, 2)) AS b FROM scored WHERE split = 'validation') AS g""")
add("ag_pred_totals", lambda spark, folder: M.prediction_totals(tiered(spark, folder)),
    "SELECT risk_tier, count(*) AS claims, CAST(sum(predicted_denial) AS BIGINT) AS predicted_denials FROM tiered GROUP BY risk_tier")


def ml_select(spark, folder) -> DataFrame:
    """Raw and calibrated card order claims alike, so their tie is settled by preference."""
    held = card_scores(spark, folder).filter(F.col(K.SPLIT) == "validation")
    rows = held.select(K.KEY, F.col(K.TARGET).alias("label"), F.inline(F.array(
        F.struct(F.lit("LR").alias("model"), F.col("margin").alias("prob")),
        F.struct(F.lit("Cal-LR").alias("model"), (F.col("margin") * 0.98).alias("prob")),
        F.struct(F.lit("Gaps").alias("model"), (F.col("total_admin_gaps") / 5).alias("prob")),
    )))
    place = F.when(F.col("model") == "LR", 0).when(F.col("model") == "Cal-LR", 1).otherwise(2)
    captures = M.score_summary(rows).select("model", F.col("capture_at_k").alias("capture"), place.alias("position"))
    best = M.select_model(captures)
    return best.select("best_model", F.round("best_capture", 9).alias("best_capture"), "tied")


add("ml_select", ml_select, """
SELECT arg_min(model, other * 10 + position) AS best_model, round(max(best), 9) AS best_capture, count(*) AS tied
FROM (SELECT *, max(capture) OVER () AS best, CASE WHEN model = 'Cal-LR' THEN 0 ELSE 1 END AS other
  FROM (SELECT model, position, sum(label) FILTER (place <= k) / CAST(sum(label) AS DOUBLE) AS capture
    FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY s DESC, claim_id) AS place,
        greatest(1, floor(count(*) OVER (PARTITION BY model) * 0.25e0)) AS k
      FROM (SELECT 'LR' AS model, 0 AS position, claim_id, is_denied AS label, margin AS s FROM scored WHERE split = 'validation'
        UNION ALL SELECT 'Cal-LR', 1, claim_id, is_denied, margin * 0.98e0 FROM scored WHERE split = 'validation'
        UNION ALL SELECT 'Gaps', 2, claim_id, is_denied, total_admin_gaps / 5e0 FROM scored WHERE split = 'validation') AS m) AS r
    GROUP BY model, position) AS c) AS t WHERE best - capture < 1e-9""")


def ml_vote_combine(spark, folder) -> DataFrame:
    """The combination step of a vote, on three ready-made probabilities with weights 2, 1 and 1."""
    scored = card_scores(spark, folder)
    parts = [F.col("prob"), F.col("raw_prob"), F.col("total_admin_gaps") / 5]
    return scored.select(K.KEY, F.round(weighted_vote(parts, (2, 1, 1)), 9).alias("vote"))


add("ml_vote_combine", ml_vote_combine,
    "SELECT claim_id, round((2e0 * prob + raw_prob + total_admin_gaps / 5e0) / 4e0, 9) AS vote FROM scored")

# --- scoring and tiers --------------------------------------------------------------------------

add("sc_score", lambda spark, folder: card_scores(spark, folder).select(
    K.KEY, F.round("margin", 9).alias("margin"), F.round("raw_prob", 9).alias("raw_prob"), F.round("prob", 9).alias("prob")),
    "SELECT claim_id, round(margin, 9) AS margin, round(raw_prob, 9) AS raw_prob, round(prob, 9) AS prob FROM scored")


def sc_sort(spark, folder) -> DataFrame:
    return tiered(spark, folder).select("rank", K.KEY, F.round("denial_probability", 9).alias("denial_probability"))


add("sc_sort", sc_sort, "SELECT rank, claim_id, round(prob, 9) AS denial_probability FROM tiered")


def sc_predict(spark, folder) -> DataFrame:
    limit = card_threshold(history_claims(spark, folder), SCORECARD)
    scored = score_with_card(current_claims(spark, folder), SCORECARD)
    return scored.select(K.KEY, S.predicted(F.col("denial_probability"), F.lit(limit)).alias("predicted_denial"))


add("sc_predict", sc_predict, "SELECT claim_id, predicted_denial FROM tiered")
add("sc_tier_rank", lambda spark, folder: tiered(spark, folder).select("rank", K.KEY, "risk_tier"),
    "SELECT rank, claim_id, risk_tier FROM tiered")
add("sc_label_threshold", lambda spark, folder: card_scores(spark, folder).select(K.KEY, S.risk_label(F.col("prob")).alias("risk_label")),
    "SELECT claim_id, CASE WHEN prob >= 0.5e0 THEN 'High' WHEN prob >= 0.25e0 THEN 'Medium' ELSE 'Low' END AS risk_label FROM scored")


def sc_topn_preview(spark, folder) -> DataFrame:
    top = S.top_rows(score_with_card(current_claims(spark, folder), SCORECARD), 3)
    return top.select(K.KEY, F.round("denial_probability", 3).alias("denial_probability"), A.factor_text(F.col("factors")).alias("top_risk_factors"))


add("sc_topn_preview", sc_topn_preview,
    "SELECT claim_id, round(prob, 3) AS denial_probability, array_to_string(factors, ', ') AS top_risk_factors FROM tiered WHERE rank <= 3")

# --- risk factors -------------------------------------------------------------------------------


def _current(spark, folder) -> DataFrame:
    return card_scores(spark, folder).filter(F.col(K.SPLIT) == "current")


_NAMES = SCORECARD.names


def rf_contrib(spark, folder) -> DataFrame:
    rows = _current(spark, folder)
    return rows.select(K.KEY, *[F.round(F.get("contributions", F.lit(i)), 9).alias(n.replace(" ", "_")) for i, n in enumerate(_NAMES)])


add("rf_contrib", rf_contrib, "SELECT claim_id, " + ", ".join(
    f'round(t[{i + 1}], 9) AS "{n.replace(" ", "_")}"' for i, n in enumerate(_NAMES)) + " FROM scored WHERE split = 'current'")


def rf_topn(spark, folder) -> DataFrame:
    tops = _current(spark, folder).select(K.KEY, F.posexplode(A.top_factors(F.col("contributions"), _NAMES, 3)).alias("at", "f"))
    return tops.select(K.KEY, (F.col("at") + 1).alias("place"), F.col("f.feature").alias("feature"), F.round("f.contribution", 9).alias("contribution"))


add("rf_topn", rf_topn, "SELECT claim_id, CAST(place AS INTEGER) AS place, name AS feature, round(c, 9) AS contribution FROM factors JOIN names USING (idx) WHERE place <= 3")


def _label_use(chooser, out: str):
    """How many current claims a feature raises, with its label."""
    def run(spark, folder) -> DataFrame:
        raised = F.filter(F.transform("contributions", lambda c, i: F.when(c > 0, i)), lambda i: i.isNotNull())
        used = _current(spark, folder).select(F.explode(raised).alias("idx")).groupBy("idx").agg(F.count("*").alias("claims"))
        names = F.array(*[F.lit(n) for n in _NAMES])
        at = F.col("idx") + 1
        return used.select(F.element_at(names, at).alias("feature"), F.element_at(label_array(_NAMES, chooser), at).alias(out), "claims")
    return run


add("rf_label_lib", _label_use(friendly_label, "label"),
    "SELECT name AS feature, friendly_label AS label, count(*) AS claims FROM factors JOIN names USING (idx) GROUP BY ALL")
add("rf_label_pipe", _label_use(ordered_label, "label"),
    "SELECT name AS feature, ordered_label AS label, count(*) AS claims FROM factors JOIN names USING (idx) GROUP BY ALL")


def nm_sanitise(spark, folder) -> DataFrame:
    """Matrix column names of every category level in the data, with its number of claims."""
    claims = claims_from_orders(spark, folder)
    levels = claims.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in K.CATEGORIES
    ]))).groupBy("column", "level").agg(F.count("*").alias("claims"))
    # One row a level, all of which the matrix names in the driver as well; levels whose safe names are equal are added up.
    named = [(feature_name(r["column"], r["level"]), r["claims"]) for r in levels.collect()]
    return spark.createDataFrame(named, "feature string, claims long").groupBy("feature").agg(F.sum("claims").alias("claims"))


add("nm_sanitise", nm_sanitise, """
SELECT replace(replace(replace(replace(name, '[', '_'), ']', '_'), '<', '_'), '>', '_') AS feature, count(*) AS claims
FROM (SELECT unnest(['payer_type_' || payer_type, 'visit_type_' || visit_type, 'payer_id_' || payer_id]) AS name FROM claims) AS n GROUP BY 1""")


def rf_string_lib(spark, folder) -> DataFrame:
    """Gate and factors from the same, uncalibrated model."""
    text = A.factor_text(A.friendly_factors(F.col("raw_prob"), F.col("contributions"), _NAMES))
    return _current(spark, folder).select(K.KEY, text.alias("top_risk_factors"))


add("rf_string_lib", rf_string_lib, """
SELECT s.claim_id, CASE WHEN s.raw_prob < 0.25e0 OR l.text IS NULL THEN 'No actionable pre-submission risk flags detected' ELSE l.text END AS top_risk_factors
FROM (SELECT claim_id, raw_prob FROM scored WHERE split = 'current') AS s LEFT JOIN (
  SELECT claim_id, string_agg(friendly_label, ', ' ORDER BY first_place) AS text FROM (
    SELECT claim_id, friendly_label, min(place) AS first_place FROM factors JOIN names USING (idx) WHERE place <= 3
    GROUP BY claim_id, friendly_label) AS d GROUP BY claim_id) AS l ON l.claim_id = s.claim_id""")


def rf_string_pipe(spark, folder) -> DataFrame:
    scored = score_with_card(current_claims(spark, folder), SCORECARD)
    return scored.select(K.KEY, A.factor_text(F.col("factors")).alias("top_risk_factors"))


add("rf_string_pipe", rf_string_pipe, "SELECT claim_id, array_to_string(factors, ', ') AS top_risk_factors FROM picked")
add("rf_rules", lambda spark, folder: _current(spark, folder).select(K.KEY, A.factor_text(A.rule_factors(F.col("prob"))).alias("top_risk_factors")), """
SELECT claim_id, CASE WHEN prob < 0.25e0 OR len(held) = 0 THEN 'No actionable pre-submission risk flags detected' ELSE array_to_string(held[1:3], ', ') END AS top_risk_factors
FROM (SELECT claim_id, prob, list_filter([
  CASE WHEN auth_gap = 1 THEN 'Missing Required Prior Authorization' END,
  CASE WHEN missing_documentation_flag = 1 THEN 'Missing Supporting Documentation' END,
  CASE WHEN eligibility_verified = 0 THEN 'Patient Eligibility Not Verified' END,
  CASE WHEN referral_gap = 1 THEN 'Missing Required Referral' END,
  CASE WHEN late_filing = 1 THEN 'Late Claim Submission (>30 days)' END,
  CASE WHEN is_in_network = 0 THEN 'Provider Not in Payer Network' END], lambda x: x IS NOT NULL) AS held FROM scored WHERE split = 'current') AS r""")


def rf_action(spark, folder) -> DataFrame:
    scored = score_with_card(current_claims(spark, folder), SCORECARD)
    pairs = F.arrays_zip(F.col("factors"), A.factor_actions(F.col("factors")).alias("actions"))
    return scored.select(K.KEY, F.inline(F.transform(pairs, lambda p: F.struct(p["factors"].alias("factor"), p["actions"].alias("action")))))


add("rf_action", rf_action, f"""SELECT claim_id, factor, coalesce(map_extract(MAP {{{", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in K.ACTIONS.items())}}}, factor)[1],
  {quoted(K.DEFAULT_ACTION)}) AS action FROM (SELECT claim_id, unnest(factors) AS factor FROM picked) AS p""")

# --- lookups ------------------------------------------------------------------------------------


def jn_lookup_claim(spark, folder) -> DataFrame:
    claims = current_claims(spark, folder)
    found = S.claim_lookup(score_with_card(claims, SCORECARD), claims, ["payer_id", "visit_type", "days_to_submit"])
    return found.select(K.KEY, F.round("denial_probability", 9).alias("denial_probability"), "payer_id", "visit_type", F.col("days_to_submit").cast("double").alias("days_to_submit"))


_LOOKUP = "SELECT claim_id, round(prob, 9) AS denial_probability, payer_id, visit_type, days_to_submit FROM scored WHERE split = 'current'"
add("jn_lookup_claim", jn_lookup_claim, _LOOKUP)


def jn_positional(spark, folder) -> DataFrame:
    """Scores stay with their claim because the id is carried along; nothing is matched by position."""
    scored = SCORECARD.score(features(spark, folder), "prob").filter(F.col(K.SPLIT) == "current")
    return scored.select(K.KEY, F.round("prob", 9).alias("denial_probability"), "payer_id", "visit_type", "days_to_submit")


add("jn_positional", jn_positional, _LOOKUP)
