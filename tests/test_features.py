import pytest
from pyspark.sql import functions as F

from claim_rows import CLAIM_COLUMNS, THREE_CLAIMS
from riskledger.functions.features import add_features, add_interactions, model_inputs
from riskledger.sources.claims import as_typed, read_raw, read_typed


def by_id(frame, *columns):
    return {r["claim_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def altered(spark, **changes):
    row = dict(zip(CLAIM_COLUMNS, THREE_CLAIMS[0])) | changes
    return spark.createDataFrame([tuple(row[c] for c in CLAIM_COLUMNS)], ", ".join(f"{c} string" for c in CLAIM_COLUMNS))


def test_gaps_and_late_filing(three_claims):
    got = by_id(add_features(three_claims), "auth_gap", "referral_gap", "late_filing", "total_admin_gaps", "is_high_risk_combo")
    assert got == {"C001": (1, 0, 0, 1, 0), "C002": (0, 1, 1, 2, 0), "C003": (0, 0, 0, 2, 1)}


def test_amounts(three_claims):
    row = add_features(three_claims).filter("claim_id = 'C001'").first()
    assert row.payment_ratio == pytest.approx(0.8)
    assert row.payment_gap == 2000
    assert row.billed_per_procedure == pytest.approx(10000 / 3)
    assert row.complexity_score == 6
    assert (row.service_month_num, row.service_quarter) == (6, 2)


def test_types_and_row_count(three_claims):
    frame = add_features(three_claims)
    types = dict(frame.dtypes)
    assert types["total_billed"] == "double" and types["total_admin_gaps"] == "int"
    assert frame.count() == 3
    assert frame.filter(" or ".join(f"{c} is null" for c in ("auth_gap", "doc_issue", "elig_issue", "network_issue"))).count() == 0


@pytest.mark.parametrize("days, number, name", [("0", 1, "<1wk"), ("7", 1, "<1wk"), ("8", 2, "1-2wk"), ("30", 3, "2-4wk"), ("31", 4, "1-2mo"), ("100", 5, ">2mo")])
def test_delay_buckets_close_on_the_right(spark, days, number, name):
    claim = altered(spark, days_to_submit=days)
    assert add_features(claim).first().submission_delay == number
    assert add_features(claim, bucket_labels="text").first().submission_delay == name


def test_missing_and_unreadable_numbers(spark):
    claim = altered(spark, days_to_submit="soon", total_billed="NaN")
    row = add_features(claim, bucket_labels="text", strict=False).first()
    assert row.days_to_submit is None and row.total_billed is None
    assert row.late_filing == 0 and row.submission_delay is None and row.payment_ratio is None


def test_strict_mode_rejects_bad_values(spark):
    for change in ({"days_to_submit": "101"}, {"has_prior_auth": "maybe"}, {"has_prior_auth": None}):
        with pytest.raises(Exception):
            add_features(altered(spark, **change)).collect()


def test_model_inputs(three_claims):
    inputs = model_inputs(three_claims)
    assert "claim_id" not in inputs.columns and "service_month" not in inputs.columns
    assert {"auth_gap", "late_filing"} <= set(inputs.columns)
    labelled = three_claims.withColumn("is_denied", F.lit(1))
    assert "is_denied" in model_inputs(labelled, drop_target=False).columns
    assert "is_denied" not in model_inputs(labelled).columns


def test_interactions(three_claims):
    row = add_interactions(add_features(three_claims)).filter("claim_id = 'C002'").first()
    assert (row.billed_x_admin_gaps, row.billed_x_doc_issue) == (10000, 5000)


def test_csv_reading(spark, three_claims, tmp_path):
    path = str(tmp_path / "claims")
    three_claims.withColumn("payer_id", F.when(F.col("claim_id") == "C001", "NA").otherwise(F.col("payer_id"))).write.option("header", True).csv(path)
    raw = read_raw(spark, path)
    assert set(t for _, t in raw.dtypes) == {"string"}
    assert raw.filter("payer_id is null").count() == 1
    typed = read_typed(spark, path)
    assert dict(typed.dtypes)["days_to_submit"] == "double" and dict(typed.dtypes)["has_prior_auth"] == "int"
    assert as_typed(raw).count() == 3


def test_features_need_no_shuffle(three_claims):
    assert "Exchange" not in add_features(three_claims)._jdf.queryExecution().executedPlan().toString()
