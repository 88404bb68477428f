import pytest
from pyspark.sql import functions as F

from riskledger.operators import contract as C


def scored(spark, rows=500):
    rank = F.col("id") + 1
    return spark.range(rows).select(
        rank.alias("rank"),
        F.format_string("CCLM-%05d", F.col("id")).alias("claim_id"),
        (F.lit(0.95) - F.col("id") * (0.94 / 499)).alias("denial_probability"),
        F.when(rank <= 125, 1).otherwise(0).alias("predicted_denial"),
        F.when(rank <= 125, "High").when(rank <= 250, "Medium").otherwise("Low").alias("risk_tier"),
        F.lit("Missing Auth").alias("top_risk_factors"),
        F.when(rank <= 10, "Test explanation").otherwise("N/A").alias("explanation"),
    )


def change(frame, column, where, value):
    return frame.withColumn(column, F.when(F.expr(where), value).otherwise(F.col(column)))


def test_valid_output_passes(spark):
    C.validate_output(scored(spark))


@pytest.mark.parametrize("rule, spoil", [
    ("out_row_count", lambda f: f.filter("rank <= 400")),
    ("out_columns", lambda f: f.drop("explanation")),
    ("out_tier_count_high", lambda f: change(f, "risk_tier", "rank <= 11", F.lit("Low"))),
    ("out_binary_pred", lambda f: change(f, "predicted_denial", "rank = 1", F.lit(2))),
    ("out_prob_range", lambda f: change(f, "denial_probability", "rank = 1", F.lit(1.5))),
    ("out_monotonic", lambda f: change(f, "denial_probability", "rank = 1", F.lit(0.94))),
    ("out_preview_text", lambda f: change(f, "explanation", "rank = 1", F.lit(""))),
    ("out_tier_domain", lambda f: change(f, "risk_tier", "rank = 1", F.lit("Unknown"))),
    ("out_unique_key", lambda f: change(f, "claim_id", "rank = 2", F.lit("CCLM-00000"))),
])
def test_each_output_rule_fails_on_its_fault(spark, rule, spoil):
    # A tie of the first two rows in the monotonic case is lifted by lowering the first one.
    with pytest.raises(C.ContractError, match=rule):
        C.validate_output(spoil(scored(spark)))


def claims(spark, *rows):
    return spark.createDataFrame(rows, "claim_id string, split string, is_denied string, denial_reason string, total_billed string, expected_payment string")


GOOD = [("A", "train", "0", None, "10", "5"), ("B", "validation", "1", "x", "10", "10"), ("C", "test", "0", None, None, "5")]


def report(history, current, **options):
    found = C.check_inputs(history, current, expected_history=3, expected_current=1, **options)
    return {r.rule: r.violations for r in found.collect() if not r.passed}


def test_inputs(spark):
    current = spark.createDataFrame([("Z",)], "claim_id string")
    assert report(claims(spark, *GOOD), current) == {}
    assert report(claims(spark, *GOOD), spark.createDataFrame([("A",)], "claim_id string")) == {"key_overlap": 1}
    bad = claims(spark, ("A", "train", "2", None, "10", "11"), ("A", "train", None, None, "NaN", "5"), (None, "later", "1", None, "1", "NaN"))
    assert report(bad, current) == {"history_unique_key": 2, "split_domain": 3, "binary_target": 2, "payment_le_billed": 1}
    assert report(claims(spark, *GOOD).drop("denial_reason"), current) == {"history_required_columns": 1}
    assert set(report(claims(spark, *GOOD[:2]), current)) == {"history_row_count", "split_domain"}


def test_strict_mode_names_the_rules(spark):
    current = spark.createDataFrame([("A",)], "claim_id string")
    with pytest.raises(C.ContractError, match="key_overlap"):
        C.enforce(C.check_inputs(claims(spark, *GOOD), current, 3, 1))


def test_quoted_fields_and_number_like_text(spark, tmp_path):
    from riskledger.functions.features import numeric
    from riskledger.sources.claims import read_raw

    (tmp_path / "claims.csv").write_text('claim_id,payer_id\nA,"Blue ""X"", Inc"\nB,"two\nlines"\nC,P3\n')
    rows = read_raw(spark, str(tmp_path / "claims.csv"), multi_line=True).orderBy("claim_id").collect()
    assert [tuple(r) for r in rows] == [("A", 'Blue "X", Inc'), ("B", "two\nlines"), ("C", "P3")]
    texts = spark.createDataFrame([(t,) for t in ("5d", "10f", "0x1p3", " 2.5 ", "1e3", "nan", "-.5", "")], "v string")
    assert [r[0] for r in texts.select(numeric("v")).collect()] == [None, None, None, 2.5, 1000.0, None, -0.5, None]
