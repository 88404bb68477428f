import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.wording import feature_name, friendly_label, ordered_label
from riskledger.operators import attribution as A


@pytest.mark.parametrize("name, label", [
    ("auth_gap", "Missing Required Prior Authorization"),
    ("referral_gap", "Missing Required Referral"),
    ("payer_type_Medicaid_MCO", "High-risk payer type: Medicaid MCO"),
    ("visit_type_Inpatient", "High-risk visit type: Inpatient"),
    ("payer_id_P008", "High-risk segment: Payer ID: P008"),
    ("submission_delay_1-2wk", "Submission Delay: 1-2wk"),
    ("payer_id", "Payer-Specific Risk Profile"),
    ("some_random_feature", "Some Random Feature"),
])
def test_friendly_labels(name, label):
    assert friendly_label(name) == label


@pytest.mark.parametrize("name, label", [
    ("payer_id_P008", "High-risk segment: Payer ID: P008"),
    ("oon_referral_gap", "Missing Required Referral"),
    ("oon_auth_gap", "Out-of-network with missing authorization"),
    ("network_issue", "Provider Not in Payer Network"),
    ("days_to_submit", "Late Claim Submission (>30 days)"),
    ("service_month_num", None),
    ("service_quarter", "Service Quarter"),
    ("billed_x_doc_issue", "Missing Supporting Documentation"),
])
def test_ordered_labels(name, label):
    assert ordered_label(name) == label


def test_corrected_order_reaches_the_shadowed_label():
    assert ordered_label("oon_referral_gap", narrow_first=True) == "Out-of-network with missing referral"


def test_feature_names_are_safe():
    assert feature_name("payer_type", "A[1]<2>") == "payer_type_A_1__2_"


NAMES = ["auth_gap", "referral_gap", "late_filing", "elig_issue", "double_deficit"]


def top(spark, weights, names, n):
    row = spark.createDataFrame([(Vectors.dense([1.0] * len(weights)),)], ["features"])
    found = row.select(A.top_factors(A.contributions(F.col("features"), weights), names, n).alias("t")).first().t
    return [(f.feature, f.contribution) for f in found]


def test_only_positive_contributions(spark):
    assert top(spark, [0.5, -0.3, 1.2, -0.1, 0.0], NAMES, 3) == [("late_filing", 1.2), ("auth_gap", 0.5)]


def test_limit_order_and_ties(spark):
    assert [f for f, _ in top(spark, [1, 2, 3, 4, 5], list("abcde"), 2)] == ["e", "d"]
    assert [f for f, _ in top(spark, [1, 1, 1], list("abc"), 2)] == ["a", "b"]


def factors(spark, build, prob, weights, names):
    row = spark.createDataFrame([(prob, [float(w) for w in weights])], "prob double, c array<double>")
    return row.select(A.factor_text(build(F.col("prob"), F.col("c"), names)).alias("t")).first().t


@pytest.mark.parametrize("build", [A.friendly_factors, A.ordered_factors])
def test_gate_and_empty(spark, build):
    assert factors(spark, build, 0.1, [0.5, 0.3], NAMES[:2]) == K.NO_FLAGS
    assert factors(spark, build, 0.6, [-0.5, -1.0], NAMES[:2]) == K.NO_FLAGS
    assert factors(spark, build, 0.8, [2.0, -0.5], NAMES[:2]) == "Missing Required Prior Authorization"


def test_duplicate_labels_before_and_after_the_cut(spark):
    names, weights = ["missing_documentation_flag", "doc_issue", "auth_gap", "service_month_num", "is_high_risk_combo"], [5, 4, 3, 2, 1]
    assert factors(spark, A.ordered_factors, 0.9, weights, names) == (
        "Missing Supporting Documentation, Missing Required Prior Authorization, High-risk payer & visit combination"
    )
    assert factors(spark, A.friendly_factors, 0.9, weights, names) == (
        "Missing Supporting Documentation, Doc Issue, Missing Required Prior Authorization"
    )
