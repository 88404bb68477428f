"""Row-local feature expressions over a claims table.

All features are plain column expressions: a filter or a projection around them still reaches the
scan, and the whole set runs in one code-generated stage without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K

PRECISE_EPS = 1e-9
COARSE_EPS = 1e-5


#: Decimal notation: the cast alone also takes type suffixes and hexadecimal text.
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|(?i)^\s*[+-]?inf(inity)?\s*$"


def numeric(name: str) -> Column:
    """Number or missing: unreadable text and NaN both become null."""
    value = F.col(name).try_cast("double")
    return F.when(F.col(name).cast("string").rlike(_DECIMAL) & ~F.isnan(value), value)


def flag(name: str, strict: bool = True) -> Column:
    """0/1 integer; in strict mode a bad or missing value fails the job."""
    value = F.col(name).try_cast("int")
    if not strict:
        return value
    return F.coalesce(value, F.raise_error(F.lit(f"{name}: not an integer flag")).cast("int"))


def _is(condition: Column) -> Column:
    """0/1 where a missing comparison counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _pair(left: str, left_value: int, right: str, right_value: int) -> Column:
    return _is((F.col(left) == left_value) & (F.col(right) == right_value))


def month_start(name: str = K.MONTH) -> Column:
    return F.to_date(F.col(name), "yyyy-MM")


def delay_bucket(days: Column, labels: str = "ordinal", strict: bool = True) -> Column:
    """Right-closed bucket of the days to submit; the first bucket also takes its lower edge.

    ``labels`` is ``"ordinal"`` (1..5) or ``"text"``.  Days outside the edges, or missing, are null
    for text labels and for non-strict ordinals, and fail the job for strict ordinals.
    """
    edges = K.DELAY_EDGES
    names = range(1, len(edges)) if labels == "ordinal" else K.DELAY_NAMES
    bucket = None
    for upper, name in zip(edges[1:], names):
        rule = days <= upper
        bucket = F.when(days < edges[0], None) if bucket is None else bucket
        bucket = bucket.when(rule, F.lit(name))
    if labels == "ordinal" and strict:
        return F.coalesce(bucket, F.raise_error(F.lit("days_to_submit outside the buckets")).cast("int"))
    return bucket


def add_features(
    claims: DataFrame,
    eps: float = PRECISE_EPS,
    bucket_labels: str = "ordinal",
    strict: bool = True,
) -> DataFrame:
    """Typed columns plus the 21 derived features.

    ``eps`` keeps the ratios finite; ``bucket_labels`` picks numbers or names for the delay bucket.
    """
    typed = {name: numeric(name) for name in K.NUMERIC}
    typed |= {name: flag(name, strict) for name in K.FLAGS if name in claims.columns}
    month = month_start()
    eps_lit = F.lit(float(eps))
    billed, expected = F.col("total_billed"), F.col("expected_payment")
    first = {
        "service_month_num": F.month(month),
        "service_quarter": F.quarter(month),
        "auth_gap": _pair("prior_auth_required", 1, "has_prior_auth", 0),
        "referral_gap": _pair("referral_required", 1, "referral_present", 0),
        "doc_issue": F.col("missing_documentation_flag"),
        "elig_issue": _is(F.col("eligibility_verified") == 0),
        "network_issue": _is(F.col("is_in_network") == 0),
        "late_filing": _is(F.col("days_to_submit") > K.LATE_DAYS),
        "payment_ratio": expected / (billed + eps_lit),
        "payment_gap": billed - expected,
        "log_total_billed": F.log1p(billed),
        "log_expected_payment": F.log1p(expected),
        "billed_per_procedure": billed / (F.col("num_procedures") + eps_lit),
        "billed_per_diagnosis": billed / (F.col("num_diagnoses") + eps_lit),
        "complexity_score": F.col("num_procedures") * F.col("num_diagnoses"),
        "is_high_risk_combo": _is(
            (F.col("payer_type") == "Medicaid MCO") & F.col("visit_type").isin("Inpatient", "Emergency")
        ),
        "submission_delay": delay_bucket(F.col("days_to_submit"), bucket_labels, strict),
    }
    second = {
        "total_admin_gaps": sum((F.col(g) for g in K.GAP_FLAGS[1:]), F.col(K.GAP_FLAGS[0])),
        "oon_auth_gap": _pair("is_in_network", 0, "auth_gap", 1),
        "oon_referral_gap": _pair("is_in_network", 0, "referral_gap", 1),
        "double_deficit": _pair("auth_gap", 1, "missing_documentation_flag", 1),
    }
    wide = claims.withColumns(typed).withColumns(first).withColumns(second)
    kept = [c for c in claims.columns if c not in K.DERIVED]
    return wide.select(*kept, *K.DERIVED)


def add_interactions(features: DataFrame) -> DataFrame:
    """The two billed-amount interactions used by the extended feature set."""
    return features.withColumns({
        "billed_x_admin_gaps": F.col("total_billed") * F.col("total_admin_gaps"),
        "billed_x_doc_issue": F.col("total_billed") * F.col("doc_issue"),
    })


def model_inputs(claims: DataFrame, drop_target: bool = True) -> DataFrame:
    """Only columns a model may see; features are added first where they are absent."""
    ready = claims if "auth_gap" in claims.columns else add_features(claims)
    return ready.drop(*K.NON_FEATURES, *([K.TARGET] if drop_target else []))


def take_split(history: DataFrame, name: str) -> DataFrame:
    return history.filter(F.col(K.SPLIT) == name)


def join_splits(*parts: DataFrame) -> DataFrame:
    """Rows of all parts under one schema, matched by column name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
