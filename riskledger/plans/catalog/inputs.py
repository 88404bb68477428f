"""Queries: reading and writing, data contract, features, projections and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions import features as X
from riskledger.operators import contract as C
from riskledger.operators.explain import explain
from riskledger.plans.catalog.base import SCORECARD, add, claims_from_orders, current_claims, features, history_claims, quoted, tiered
from riskledger.plans.review import publish
from riskledger.sources import claims as R
from riskledger.workspace import fresh_path, stage_table

# --- claim files --------------------------------------------------------------------------------

_TEXT_COLUMNS = (K.KEY, *K.CATEGORIES, "days_to_submit", *K.FLAGS, K.MONTH, K.SPLIT, K.TARGET, K.REASON)


def _claims_csv(spark, folder) -> str:
    path = fresh_path(spark, "claims-csv")
    claims_from_orders(spark, folder).write.option("header", True).csv(path)
    return path


def io_read_raw(spark, folder) -> DataFrame:
    raw = R.read_raw(spark, _claims_csv(spark, folder))
    return raw.select(*_TEXT_COLUMNS, F.round(F.col("total_billed").cast("double"), 4).alias("total_billed"))


def io_read_typed(spark, folder) -> DataFrame:
    typed = R.read_typed(spark, _claims_csv(spark, folder))
    return typed.select(
        K.KEY, *K.CATEGORIES, F.round("total_billed", 4).alias("total_billed"),
        F.round("expected_payment", 4).alias("expected_payment"),
        "num_procedures", "num_diagnoses", "days_to_submit", *K.FLAGS, K.MONTH, K.SPLIT, K.TARGET, K.REASON,
    )


_CSV_TEXT = ", ".join(
    f"CAST(CAST({c} AS BIGINT) AS VARCHAR) AS {c}" if c in (*K.FLAGS, "days_to_submit", K.TARGET) else c for c in _TEXT_COLUMNS
)
add("io_read_raw", io_read_raw, f"SELECT {_CSV_TEXT}, round(total_billed, 4) AS total_billed FROM labelled")
add("io_read_typed", io_read_typed, f"""
SELECT claim_id, {", ".join(K.CATEGORIES)}, round(total_billed, 4) AS total_billed, round(expected_payment, 4) AS expected_payment,
  num_procedures, num_diagnoses, days_to_submit, {", ".join(K.FLAGS)}, service_month, split, is_denied, denial_reason FROM labelled""")

# --- input rules --------------------------------------------------------------------------------


def _inputs(*rules: str):
    def run(spark, folder) -> DataFrame:
        return C.check_inputs(history_claims(spark, folder), current_claims(spark, folder), only=rules)
    return run


def _rule_sql(*items: tuple[str, str, str]) -> str:
    """(rule, violation count, source) rows as one report."""
    parts = [
        f"SELECT {quoted(rule)} AS rule, CAST({count} AS BIGINT) AS violations, ({count}) = 0 AS passed {source}"
        for rule, count, source in items
    ]
    return " UNION ALL ".join(parts)


_HIST, _CURR = "FROM labelled WHERE split <> 'current'", "FROM labelled WHERE split = 'current'"
add("dq_row_count", _inputs("history_row_count", "current_row_count"), _rule_sql(
    ("history_row_count", "abs(count(*) - 3200)", _HIST), ("current_row_count", "abs(count(*) - 500)", _CURR)))
add("dq_unique_key", _inputs("history_unique_key", "current_unique_key"), _rule_sql(
    ("history_unique_key", "count(*) - count(DISTINCT claim_id)", _HIST),
    ("current_unique_key", "count(*) - count(DISTINCT claim_id)", _CURR)))
add("dq_key_overlap", _inputs("key_overlap"), _rule_sql(
    ("key_overlap", "count(*)", f"FROM (SELECT claim_id {_HIST} INTERSECT SELECT claim_id {_CURR}) AS b")))
add("dq_required_cols", _inputs("history_required_columns", "current_required_columns"), _rule_sql(
    ("history_required_columns", "4 - count(*)", "FROM (SELECT unnest(['claim_id', 'split', 'is_denied', 'denial_reason']) AS c) AS r"),
    ("current_required_columns", "1 - count(*)", "FROM (SELECT 'claim_id' AS c) AS r")))
add("dq_split_domain", _inputs("split_domain"), _rule_sql(
    ("split_domain", "count(*) FILTER (split IS NULL OR split NOT IN ('train', 'validation', 'test')) + 3 - count(DISTINCT CASE WHEN split IN ('train', 'validation', 'test') THEN split END)", _HIST)))
add("dq_binary_target", _inputs("binary_target"), _rule_sql(
    ("binary_target", "count(*) FILTER (is_denied IS NULL OR is_denied NOT IN (0, 1))", _HIST)))
add("dq_payment_le_billed", _inputs("payment_le_billed"), _rule_sql(
    ("payment_le_billed", "count(*) FILTER (expected_payment > total_billed)", _HIST)))



def _ends(digit: int):
    return F.col(K.KEY).endswith(str(digit))


def dq_faulty_inputs(spark, folder) -> DataFrame:
    """All input rules on claims made faulty: the last digit of a claim's id tells its fault."""
    history, current = history_claims(spark, folder), current_claims(spark, folder)
    faulty = history.withColumns({
        K.SPLIT: F.when(_ends(3), F.lit("holdout")).otherwise(F.col(K.SPLIT)),
        K.TARGET: F.when(_ends(5), F.lit(2)).otherwise(F.col(K.TARGET)),
        "expected_payment": F.when(_ends(7), F.col("total_billed") + 1).otherwise(F.col("expected_payment")),
    }).drop(K.REASON)
    shared = history.filter(_ends(9)).select(*current.columns)
    return C.check_inputs(faulty.union(faulty.filter(_ends(1))), current.union(current.filter(_ends(0))).union(shared))


def _ending(digit: int, where: str) -> str:
    return f"count(*) FILTER (claim_id LIKE '%{digit}' AND {where})"


_ALL, _H, _C = "FROM labelled", "split <> 'current'", "split = 'current'"
add("dq_faulty_inputs", dq_faulty_inputs, _rule_sql(
    ("history_row_count", f"abs(count(*) FILTER ({_H}) + {_ending(1, _H)} - 3200)", _ALL),
    ("current_row_count", f"abs(count(*) FILTER ({_C}) + {_ending(0, _C)} + {_ending(9, _H)} - 500)", _ALL),
    ("history_unique_key", _ending(1, _H), _ALL),
    ("current_unique_key", _ending(0, _C), _ALL),
    ("split_domain", _ending(3, _H), _ALL),
    ("binary_target", _ending(5, _H), _ALL),
    ("payment_le_billed", _ending(7, _H), _ALL),
    ("key_overlap", _ending(9, _H), _ALL),
    ("history_required_columns", "1", ""),
    ("current_required_columns", "0", "")))

# --- output rules -------------------------------------------------------------------------------


def _published(spark, folder) -> DataFrame:
    return publish(explain(tiered(spark, folder)))


def _outputs(*rules: str):
    def run(spark, folder) -> DataFrame:
        return C.check_outputs(_published(spark, folder), expected_tiers=K.EXPECTED_TIER_ROWS, only=rules)
    return run


_OUT = "FROM tiered"
add("dq_out_shape", _outputs("out_row_count", "out_columns"), _rule_sql(
    ("out_row_count", "abs(count(*) - 500)", _OUT), ("out_columns", "count(*) FILTER (claim_id IS NULL)", _OUT)))
add("dq_out_unique", _outputs("out_unique_key"), _rule_sql(("out_unique_key", "count(*) - count(DISTINCT claim_id)", _OUT)))
add("dq_out_prob_range", _outputs("out_prob_range"), _rule_sql(
    ("out_prob_range", "count(*) FILTER (prob IS NULL OR prob < 0 OR prob > 1)", _OUT)))
add("dq_out_monotonic", _outputs("out_monotonic"), _rule_sql(
    ("out_monotonic", "count(*) FILTER (prob > before)", "FROM (SELECT prob, lag(prob) OVER (ORDER BY rank) AS before FROM tiered) AS l")))
add("dq_out_binary_pred", _outputs("out_binary_pred"), _rule_sql(
    ("out_binary_pred", "count(*) FILTER (predicted_denial NOT IN (0, 1))", _OUT)))
add("dq_out_tier_domain", _outputs("out_tier_domain"), _rule_sql(
    ("out_tier_domain", "count(*) FILTER (risk_tier NOT IN ('High', 'Medium', 'Low'))", _OUT)))
add("dq_out_tier_counts", _outputs("out_tier_count_high", "out_tier_count_medium", "out_tier_count_low"), _rule_sql(
    ("out_tier_count_high", "abs(count(*) FILTER (risk_tier = 'High') - 125)", _OUT),
    ("out_tier_count_medium", "abs(count(*) FILTER (risk_tier = 'Medium') - 125)", _OUT),
    ("out_tier_count_low", "abs(count(*) FILTER (risk_tier = 'Low') - 250)", _OUT)))
add("dq_out_top10_text", _outputs("out_preview_text"), _rule_sql(
    ("out_preview_text", "count(*) FILTER (rank <= 10 AND coalesce(explanation, '') = '')", "FROM explained")))
add("dq_out_all_text", lambda spark, folder: C.shortest_text_per_tier(_published(spark, folder)),
    "SELECT risk_tier, CAST(min(length(coalesce(explanation, ''))) AS INTEGER) AS min_chars FROM explained GROUP BY risk_tier")


def dq_faulty_outputs(spark, folder) -> DataFrame:
    """All output rules on a list made faulty in the same way, with two of its columns exchanged."""
    listed = _published(spark, folder).withColumns({
        "denial_probability": F.when(_ends(1), F.lit(1.5)).otherwise(F.col("denial_probability")),
        "predicted_denial": F.when(_ends(3), F.lit(2)).otherwise(F.col("predicted_denial")),
        "risk_tier": F.when(_ends(5), F.lit("Urgent")).otherwise(F.col("risk_tier")),
        "explanation": F.when(_ends(7), F.lit("")).otherwise(F.col("explanation")),
    })
    columns = ["rank", *K.SCORED_COLUMNS]
    columns[-2:] = columns[:-3:-1]
    faulty = stage_table(listed.select(*columns), "faulty")
    return C.check_outputs(faulty.union(faulty.filter(_ends(9))), expected_tiers=K.EXPECTED_TIER_ROWS)


_LISTED = """SELECT rank, claim_id, CASE WHEN claim_id LIKE '%1' THEN 1.5e0 ELSE prob END AS prob,
  CASE WHEN claim_id LIKE '%5' THEN 'Urgent' ELSE risk_tier END AS tier FROM tiered"""
_FAULTY = f"FROM ({_LISTED} UNION ALL {_LISTED} WHERE claim_id LIKE '%9') AS f"
add("dq_faulty_outputs", dq_faulty_outputs, _rule_sql(
    ("out_row_count", "abs(count(*) - 500)", _FAULTY),
    ("out_unique_key", "count(*) - count(DISTINCT claim_id)", _FAULTY),
    ("out_prob_range", _ending(1, "true"), _FAULTY),
    ("out_binary_pred", _ending(3, "true"), _FAULTY),
    ("out_tier_domain", _ending(5, "true"), _FAULTY),
    *[(f"out_tier_count_{t.lower()}", f"abs(count(*) FILTER (tier = '{t}') - {n})", _FAULTY) for t, n in K.EXPECTED_TIER_ROWS.items()],
    ("out_preview_text", _ending(7, "rank <= 10"), _FAULTY),
    ("out_all_text", _ending(7, "true"), _FAULTY),
    ("out_monotonic", "count(*) FILTER (prob > before)", f"FROM (SELECT prob, lag(prob) OVER (ORDER BY rank) AS before {_FAULTY}) AS l"),
    ("out_columns", "1", "")))

# --- features -----------------------------------------------------------------------------------


def _feature(*columns: str):
    def run(spark, folder) -> DataFrame:
        frame = features(spark, folder)
        doubles = {c for c, t in frame.dtypes if t == "double"}
        return frame.select(K.KEY, *[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in columns])
    return run


_DOUBLES = {
    *K.NUMERIC, "payment_ratio", "payment_gap", "log_total_billed", "log_expected_payment", "billed_per_procedure",
    "billed_per_diagnosis", "complexity_score",
}


def _feature_sql(*columns: str) -> str:
    return "SELECT claim_id, " + ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in columns) + " FROM feats"


for _name, _columns in {
    "ft_numeric_coerce": K.NUMERIC,
    "ft_binary_cast": K.FLAGS,
    "ft_service_month_num": ("service_month_num",),
    "ft_service_quarter": ("service_quarter",),
    "ft_auth_gap": ("auth_gap",),
    "ft_referral_gap": ("referral_gap",),
    "ft_doc_issue": ("doc_issue",),
    "ft_elig_issue": ("elig_issue",),
    "ft_network_issue": ("network_issue",),
    "ft_late_filing": ("late_filing",),
    "ft_payment_ratio": ("payment_ratio",),
    "ft_payment_gap": ("payment_gap",),
    "ft_log_total_billed": ("log_total_billed",),
    "ft_log_expected_payment": ("log_expected_payment",),
    "ft_billed_per_procedure": ("billed_per_procedure",),
    "ft_billed_per_diagnosis": ("billed_per_diagnosis",),
    "ft_complexity_score": ("complexity_score",),
    "ft_total_admin_gaps": ("total_admin_gaps",),
    "ft_oon_auth_gap": ("oon_auth_gap",),
    "ft_oon_referral_gap": ("oon_referral_gap",),
    "ft_double_deficit": ("double_deficit",),
    "ft_high_risk_combo": ("is_high_risk_combo",),
    "ft_submission_delay": ("submission_delay",),
}.items():
    add(_name, _feature(*_columns), _feature_sql(*_columns))


def ft_library_variant(spark, folder) -> DataFrame:
    """The coarser epsilon and the named delay buckets."""
    wide = X.add_features(claims_from_orders(spark, folder), eps=X.COARSE_EPS, bucket_labels="text", strict=False)
    ratios = ("payment_ratio", "billed_per_procedure", "billed_per_diagnosis")
    return wide.select(K.KEY, *[F.round(c, 6).alias(c) for c in ratios], "submission_delay")


add("ft_library_variant", ft_library_variant, """
SELECT claim_id, round(expected_payment / (total_billed + 1e-5), 6) AS payment_ratio,
  round(total_billed / (num_procedures + 1e-5), 6) AS billed_per_procedure,
  round(total_billed / (num_diagnoses + 1e-5), 6) AS billed_per_diagnosis,
  ['<1wk', '1-2wk', '2-4wk', '1-2mo', '>2mo'][submission_delay] AS submission_delay FROM feats""")
add("ft_interactions", lambda spark, folder: X.add_interactions(features(spark, folder)).select(
    K.KEY, *[F.round(c, 4).alias(c) for c in K.INTERACTIONS]),
    "SELECT claim_id, round(total_billed * total_admin_gaps, 4) AS billed_x_admin_gaps, round(total_billed * doc_issue, 4) AS billed_x_doc_issue FROM feats")

# --- projections, splits, unions ----------------------------------------------------------------

_INPUT_COLUMNS = (*K.CATEGORIES, *K.MODEL_NUMERIC)


def pj_drop_leakage(spark, folder) -> DataFrame:
    inputs = X.model_inputs(history_claims(spark, folder))
    doubles = {c for c, t in inputs.dtypes if t == "double"}
    return inputs.select(*[F.round(c, 4).alias(c) if c in doubles else F.col(c) for c in inputs.columns])


add("pj_drop_leakage", pj_drop_leakage, "SELECT " + ", ".join(
    f"round({c}, 4) AS {c}" if c in _DOUBLES else c for c in _INPUT_COLUMNS) + " FROM feats WHERE split <> 'current'")


def fl_split(spark, folder) -> DataFrame:
    history = features(spark, folder).filter(F.col(K.SPLIT) != "current")
    parts = [X.take_split(history, s).select(K.KEY, F.lit(s).alias("part"), K.TARGET) for s in K.SPLITS]
    return X.join_splits(*parts)


add("fl_split", fl_split, "SELECT claim_id, split AS part, is_denied FROM feats WHERE split <> 'current'")


def st_concat_splits(spark, folder) -> DataFrame:
    history = features(spark, folder)
    whole = X.join_splits(*[X.take_split(history, s) for s in K.SPLITS])
    return whole.select(K.KEY, K.SPLIT, K.TARGET, "total_admin_gaps", "submission_delay")


_SPLITS_SQL = "SELECT claim_id, split, is_denied, total_admin_gaps, submission_delay FROM feats WHERE split <> 'current'"
add("st_concat_splits", st_concat_splits, _SPLITS_SQL)
add("st_union", lambda spark, folder: X.join_splits(history_claims(spark, folder).select(K.KEY, K.SPLIT),
    claims_from_orders(spark, folder).filter(F.col(K.SPLIT) == "current").select(K.KEY, K.SPLIT)),
    "SELECT claim_id, split FROM feats")


def jn_semi_overlap(spark, folder) -> DataFrame:
    """Ids in both the training claims and the claims that lack a referral: a non-empty intersection."""
    wide = features(spark, folder)
    return C.key_overlap(X.take_split(wide, "train"), wide.filter("referral_gap = 1"))


add("jn_semi_overlap", jn_semi_overlap,
    "SELECT claim_id FROM feats WHERE split = 'train' INTERSECT SELECT claim_id FROM feats WHERE referral_gap = 1")


def st_difference(spark, folder) -> DataFrame:
    """Claims without any line item: ids of one table that the other lacks."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("order_id"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.col("l_orderkey").alias("order_id"))
    return orders.join(lines, "order_id", "left_anti")


add("st_difference", st_difference,
    "SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
