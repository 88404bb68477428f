"""Registry of named queries and the shared inputs they start from.

A query has a Spark function ``(spark, folder) -> DataFrame`` and, where plain SQL can state the
expected result, that SQL.  Expected results are written over the same source tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import add_features
from riskledger.plans.pinned import CALIBRATION, INTERCEPT, LEVELS, NUMBERS, SCORECARD
from riskledger.plans.review import card_threshold, score_with_card
from riskledger.operators.scoring import rank_and_tier
from riskledger.sources.orders import claims_from_orders, current_claims, history_claims

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
EXPECTED: dict[str, str] = {}


def add(name: str, function: QueryFunction, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is already registered")
    QUERIES[name] = function
    if sql is not None:
        EXPECTED[name] = sql


def expected_results() -> dict[str, str]:
    """Complete SQL per query; called once all query modules have added their shared tables."""
    return {name: with_tables(sql) for name, sql in EXPECTED.items()}


# --- Spark inputs -------------------------------------------------------------------------------

def features(spark: SparkSession, folder: str) -> DataFrame:
    return add_features(claims_from_orders(spark, folder))


def card_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All claims with features, contributions and pinned probabilities (``prob``)."""
    return SCORECARD.score(features(spark, folder), "prob")


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled claims scored by three simple models, in long form.

    One model has nearly unique scores, the other two share each score among many claims.
    """
    labelled = card_scores(spark, folder).filter(F.col(K.TARGET).isNotNull())
    scores = F.array(
        F.struct(F.lit("card").alias("model"), F.col("prob").alias("prob")),
        F.struct(F.lit("delay").alias("model"), (F.col("days_to_submit") / 101).alias("prob")),
        F.struct(F.lit("gaps").alias("model"), (F.col("total_admin_gaps") / 5).alias("prob")),
    )
    return labelled.select(K.KEY, K.SPLIT, F.col(K.TARGET).alias("label"), F.inline(scores))


def tiered(spark: SparkSession, folder: str) -> DataFrame:
    """Current claims ranked and tiered by the pinned card."""
    limit = card_threshold(history_claims(spark, folder), SCORECARD)
    return rank_and_tier(score_with_card(current_claims(spark, folder), SCORECARD), limit)


# --- SQL inputs ---------------------------------------------------------------------------------

CLAIMS_SQL = """
SELECT 'CCLM-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS claim_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BCBS' WHEN 'FURNITURE' THEN 'Medicaid MCO'
    WHEN 'HOUSEHOLD' THEN 'Medicare Advantage' ELSE 'Commercial' END AS payer_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Inpatient'
    WHEN '3-MEDIUM' THEN 'Observation' ELSE 'Outpatient' END AS visit_type,
  'P' || lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 3, '0') AS payer_id,
  o_totalprice AS total_billed,
  o_totalprice * (0.4e0 + (o_custkey % 50) * 0.01e0) AS expected_payment,
  CAST(coalesce(n_lines, 1) AS DOUBLE) AS num_procedures,
  CAST(1 + o_custkey % 8 AS DOUBLE) AS num_diagnoses,
  CAST((o_orderkey * 7 + o_custkey) % 101 AS DOUBLE) AS days_to_submit,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS prior_auth_required,
  CASE WHEN o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS has_prior_auth,
  CASE WHEN o_custkey % 5 <> 0 THEN 1 ELSE 0 END AS is_in_network,
  CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS missing_documentation_flag,
  CASE WHEN o_custkey % 11 <> 0 THEN 1 ELSE 0 END AS eligibility_verified,
  CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS referral_required,
  CASE WHEN o_custkey % 3 <> 0 THEN 1 ELSE 0 END AS referral_present,
  strftime(o_orderdate, '%Y-%m') AS service_month,
  CASE WHEN o_orderstatus = 'P' THEN 'current' WHEN o_orderkey % 10 < 6 THEN 'train'
    WHEN o_orderkey % 10 < 8 THEN 'validation' ELSE 'test' END AS split,
  o_orderkey AS k, o_custkey AS u
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) AS li ON l_orderkey = o_orderkey
"""

FEATS_SQL = """
SELECT f.*, auth_gap + referral_gap + doc_issue + elig_issue + network_issue AS total_admin_gaps,
  CASE WHEN is_in_network = 0 AND auth_gap = 1 THEN 1 ELSE 0 END AS oon_auth_gap,
  CASE WHEN is_in_network = 0 AND referral_gap = 1 THEN 1 ELSE 0 END AS oon_referral_gap,
  CASE WHEN auth_gap = 1 AND missing_documentation_flag = 1 THEN 1 ELSE 0 END AS double_deficit,
  CASE WHEN split = 'current' THEN NULL WHEN 3 * auth_gap + 3 * missing_documentation_flag + 2 * referral_gap
    + late_filing + (1 - eligibility_verified) + (1 - is_in_network) + (k * 13 + u * 5) % 9 >= 9
    THEN 1 ELSE 0 END AS is_denied
FROM (
  SELECT c.*, CAST(substr(service_month, 6, 2) AS INTEGER) AS service_month_num,
    CAST((CAST(substr(service_month, 6, 2) AS INTEGER) + 2) // 3 AS INTEGER) AS service_quarter,
    CASE WHEN prior_auth_required = 1 AND has_prior_auth = 0 THEN 1 ELSE 0 END AS auth_gap,
    CASE WHEN referral_required = 1 AND referral_present = 0 THEN 1 ELSE 0 END AS referral_gap,
    missing_documentation_flag AS doc_issue,
    1 - eligibility_verified AS elig_issue,
    1 - is_in_network AS network_issue,
    CASE WHEN days_to_submit > 30 THEN 1 ELSE 0 END AS late_filing,
    expected_payment / (total_billed + 1e-9) AS payment_ratio,
    total_billed - expected_payment AS payment_gap,
    ln(1e0 + total_billed) AS log_total_billed,
    ln(1e0 + expected_payment) AS log_expected_payment,
    total_billed / (num_procedures + 1e-9) AS billed_per_procedure,
    total_billed / (num_diagnoses + 1e-9) AS billed_per_diagnosis,
    num_procedures * num_diagnoses AS complexity_score,
    CASE WHEN payer_type = 'Medicaid MCO' AND visit_type IN ('Inpatient', 'Emergency') THEN 1 ELSE 0 END AS is_high_risk_combo,
    CASE WHEN days_to_submit < 0 OR days_to_submit > 100 THEN NULL WHEN days_to_submit <= 7 THEN 1
      WHEN days_to_submit <= 14 THEN 2 WHEN days_to_submit <= 30 THEN 3 WHEN days_to_submit <= 60 THEN 4 ELSE 5 END AS submission_delay
  FROM claims AS c) AS f
"""

LABELLED_SQL = """
SELECT *, CASE WHEN is_denied IS NULL OR is_denied = 0 THEN NULL WHEN auth_gap = 1 THEN 'authorization'
    WHEN missing_documentation_flag = 1 THEN 'documentation' WHEN referral_gap = 1 THEN 'referral'
    WHEN late_filing = 1 THEN 'timely filing' WHEN eligibility_verified = 0 THEN 'eligibility'
    WHEN is_in_network = 0 THEN 'network' ELSE 'other' END AS denial_reason
FROM feats
"""


def number(value: float) -> str:
    """A float as SQL text that is read as DOUBLE, not DECIMAL."""
    text = repr(float(value))
    return text if "e" in text else text + "e0"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TERMS = [
    f"CASE WHEN {c} = {quoted(level)} THEN {number(w)} ELSE 0e0 END" for c, levels in LEVELS.items() for level, w in levels.items()
] + [f"{number(w)} * ((CAST({c} AS DOUBLE) - {number(m)}) / {number(s)})" for c, (m, s, w) in NUMBERS.items()]

SCORED_SQL = f"""
SELECT *, 1e0 / (1e0 + exp(-margin)) AS raw_prob,
  1e0 / (1e0 + exp(-({number(CALIBRATION.slope)} * margin + {number(CALIBRATION.offset)}))) AS prob
FROM (SELECT *, {number(INTERCEPT)} + {" + ".join(f"t[{i + 1}]" for i in range(len(TERMS)))} AS margin
      FROM (SELECT *, [{", ".join(TERMS)}] AS t FROM labelled) AS a) AS b
"""

MODELS_SQL = """
SELECT claim_id, split, is_denied AS label, 'card' AS model, prob FROM scored WHERE is_denied IS NOT NULL
UNION ALL SELECT claim_id, split, is_denied, 'delay', days_to_submit / 101e0 FROM scored WHERE is_denied IS NOT NULL
UNION ALL SELECT claim_id, split, is_denied, 'gaps', total_admin_gaps / 5e0 FROM scored WHERE is_denied IS NOT NULL
"""

NAMES = SCORECARD.names

FACTORS_SQL = f"""
SELECT claim_id, prob, idx, c, row_number() OVER (PARTITION BY claim_id ORDER BY c DESC, idx) AS place
FROM (SELECT claim_id, prob, unnest(t) AS c, unnest(range({len(NAMES)})) AS idx FROM scored WHERE split = 'current') AS x
WHERE c > 0
"""

# The ordered label rules once more, as SQL over feature names.
NAMES_SQL = """
SELECT CAST(position - 1 AS BIGINT) AS idx, name,
  CASE WHEN starts_with(name, 'payer_type_') THEN 'High-risk segment: Payer: ' || replace(substr(name, 12), '_', ' ')
    WHEN starts_with(name, 'visit_type_') THEN 'High-risk segment: Visit: ' || replace(substr(name, 12), '_', ' ')
    WHEN starts_with(name, 'payer_id_') THEN 'High-risk segment: Payer ID: ' || replace(substr(name, 10), '_', ' ')
    WHEN name = 'auth_gap' THEN 'Missing Required Prior Authorization'
    WHEN name IN ('missing_documentation_flag', 'doc_issue') THEN 'Missing Supporting Documentation'
    WHEN name IN ('referral_gap', 'oon_referral_gap') THEN 'Missing Required Referral'
    WHEN name IN ('eligibility_verified', 'elig_issue') THEN 'Patient Eligibility Not Verified'
    WHEN name IN ('is_in_network', 'network_issue') THEN 'Provider Not in Payer Network'
    WHEN name IN ('late_filing', 'days_to_submit') THEN 'Late Claim Submission (>30 days)'
    WHEN name = 'service_month_num' THEN NULL
    WHEN name = 'double_deficit' THEN 'Compound deficit: missing auth + documentation'
    WHEN name = 'total_admin_gaps' THEN 'Multiple administrative gaps'
    WHEN name = 'oon_auth_gap' THEN 'Out-of-network with missing authorization'
    WHEN name = 'is_high_risk_combo' THEN 'High-risk payer & visit combination'
    ELSE array_to_string(list_transform(string_split(name, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS ordered_label,
  CASE name WHEN 'auth_gap' THEN 'Missing Required Prior Authorization' WHEN 'referral_gap' THEN 'Missing Required Referral'
    WHEN 'missing_documentation_flag' THEN 'Missing Supporting Documentation'
    WHEN 'eligibility_verified' THEN 'Patient Eligibility Not Verified' WHEN 'is_in_network' THEN 'Provider Not in Payer Network'
    WHEN 'late_filing' THEN 'Late Claim Submission (>30 days)' WHEN 'days_to_submit' THEN 'Extended Days to Submit'
    WHEN 'log_total_billed' THEN 'High Claim Billed Amount' WHEN 'payment_ratio' THEN 'Low Expected Payment Ratio'
    WHEN 'complexity_score' THEN 'High Claim Complexity' WHEN 'service_month_num' THEN 'Service Month Factor'
    WHEN 'total_admin_gaps' THEN 'Multiple Administrative Gaps' WHEN 'oon_auth_gap' THEN 'Out-of-Network + Missing Authorization'
    WHEN 'oon_referral_gap' THEN 'Out-of-Network + Missing Referral'
    WHEN 'double_deficit' THEN 'Compound deficit: missing auth + documentation'
    WHEN 'is_high_risk_combo' THEN 'High-risk payer & visit combination'
    ELSE CASE WHEN starts_with(name, 'payer_type_') THEN 'High-risk payer type: ' || replace(substr(name, 12), '_', ' ')
      WHEN starts_with(name, 'visit_type_') THEN 'High-risk visit type: ' || replace(substr(name, 12), '_', ' ')
      WHEN starts_with(name, 'payer_id_') THEN 'High-risk segment: Payer ID: ' || replace(substr(name, 10), '_', ' ')
      ELSE array_to_string(list_transform(string_split(name, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') END END AS friendly_label
FROM (SELECT unnest([%s]) AS name, unnest(range(1, %d)) AS position) AS n
""" % (", ".join(quoted(n) for n in NAMES), len(NAMES) + 1)

# First three distinct ordered labels per current claim, gated on the calibrated probability.
PICKED_SQL = f"""
SELECT s.claim_id, s.prob, CASE WHEN s.prob < 0.25e0 OR l.labels IS NULL THEN [{quoted(K.NO_FLAGS)}] ELSE l.labels END AS factors
FROM (SELECT claim_id, prob FROM scored WHERE split = 'current') AS s
LEFT JOIN (SELECT claim_id, (list(ordered_label ORDER BY first_place))[1:3] AS labels
  FROM (SELECT claim_id, ordered_label, min(place) AS first_place FROM factors JOIN names USING (idx)
        WHERE ordered_label IS NOT NULL GROUP BY claim_id, ordered_label) AS d GROUP BY claim_id) AS l ON l.claim_id = s.claim_id
"""

LIMIT_SQL = "SELECT quantile_cont(prob, 0.75) AS threshold FROM scored WHERE split = 'validation'"

TIERED_SQL = """
SELECT *, CASE WHEN rank <= floor(n * 0.25e0) THEN 'High' WHEN rank <= 2 * floor(n * 0.25e0) THEN 'Medium' ELSE 'Low' END AS risk_tier,
  CASE WHEN prob >= (SELECT threshold FROM cutoff) THEN 1 ELSE 0 END AS predicted_denial
FROM (SELECT *, row_number() OVER (ORDER BY prob DESC, claim_id) AS rank, count(*) OVER () AS n FROM picked) AS r
"""

TABLES = {
    "claims": (CLAIMS_SQL, ()),
    "feats": (FEATS_SQL, ("claims",)),
    "labelled": (LABELLED_SQL, ("feats",)),
    "scored": (SCORED_SQL, ("labelled",)),
    "models": (MODELS_SQL, ("scored",)),
    "factors": (FACTORS_SQL, ("scored",)),
    "names": (NAMES_SQL, ()),
    "picked": (PICKED_SQL, ("scored", "factors", "names")),
    "cutoff": (LIMIT_SQL, ("scored",)),
    "tiered": (TIERED_SQL, ("picked", "cutoff")),
}


def with_tables(sql: str) -> str:
    """``sql`` with the derived tables it names (and theirs) in front of it."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for parent in TABLES[name][1]:
            visit(parent)
        if name not in needed:
            needed.append(name)

    for name in TABLES:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            visit(name)
    if not needed:
        return sql
    kept = {"scored", "picked", "tiered", "completions", "requests", "parsed", "written", "log"}
    heads = [f"{n} AS {'MATERIALIZED ' if n in kept else ''}({TABLES[n][0]})" for n in needed]
    return "WITH " + ",\n".join(heads) + "\n" + sql
