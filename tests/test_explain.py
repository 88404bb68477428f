import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators import audit as U
from riskledger.operators import explain as E
from riskledger.sources import stores

AUTH = "Missing Required Prior Authorization"


def rows(spark, *items):
    return spark.createDataFrame(items, "claim_id string, denial_probability double, factors array<string>, risk_tier string")


def one(spark, column, claim_id="CCLM-001", prob=0.85, factors=(AUTH,)):
    frame = rows(spark, (claim_id, prob, list(factors), "High"))
    return frame.select(column(E.request(F.col("claim_id"), F.col("denial_probability"), F.col("factors"))).alias("x")).first().x


def test_request(spark):
    got = one(spark, lambda r: r, prob=0.75, factors=["Missing Auth", "Late Filing"])
    assert (got.claim_id, got.denial_probability, got.risk_estimate_label) == ("CCLM-001", 0.75, "High")
    assert [f.permitted_action for f in got.top_risk_factors] == [K.DEFAULT_ACTION] * 2
    assert one(spark, lambda r: r, claim_id=None).claim_id == "UNKNOWN"
    assert one(spark, lambda r: r, prob=0.0625).denial_probability == 0.062


@pytest.mark.parametrize("change, expected", [
    ({}, []),
    ({"prob": 1.5}, ["denial_probability: outside 0..1"]),
    ({"prob": -0.1}, ["denial_probability: outside 0..1"]),
    ({"factors": []}, []),
    ({"factors": [f"Risk {i}" for i in range(6)]}, ["top_risk_factors: more than 5"]),
    ({"factors": [""]}, ["top_risk_factors: empty text"]),
])
def test_request_rules(spark, change, expected):
    assert one(spark, E.request_violations, **change) == expected


def test_unknown_label_is_rejected(spark):
    assert one(spark, lambda r: E.request_violations(r.withField("risk_estimate_label", F.lit("Critical")))) == ["risk_estimate_label: unknown"]


def test_prompt(spark):
    text = one(spark, E.prompt, claim_id="CCLM-ABC", prob=0.5)
    for part in ("CCLM-ABC", "Estimated Denial Probability: 0.5\n", f"  1. {AUTH}\n     Fact: {AUTH}\n", "JSON", "disclaimer"):
        assert part in text
    assert text.endswith("JSON response:") and "{" not in text
    assert K.PROMPT_NO_FACTORS in one(spark, E.prompt, factors=[])


def test_template(spark):
    text = one(spark, lambda r: E.plain_text(E.template_response(r)))
    assert text == (
        "This claim has an estimated denial risk of 85% - this is a statistical estimate, not a guaranteed outcome. "
        "A key concern is that missing required prior authorization. Recommended action: " + K.ACTIONS[AUTH]
    )
    for factors in ([], [K.NO_FLAGS]):
        routine = one(spark, lambda r: E.plain_text(E.template_response(r)), factors=factors)
        assert "No actionable" in routine and "Routine submission" in routine
    assert " 12% " in one(spark, lambda r: E.template_response(r)["disclaimer"], prob=0.125)
    assert "that risk exists. " in one(spark, lambda r: E.plain_text(E.template_response(r)), factors=["Risk exists..."])


def test_template_is_a_valid_response(spark):
    assert one(spark, lambda r: E.response_violations(E.template_response(r))) == []


@pytest.mark.parametrize("prob, factors, expected", [
    (0.10, ["Some factor"], True), (0.60, [K.NO_FLAGS], True), (0.60, ["No major issue"], True), (0.60, [], True),
    (0.60, [AUTH], False), (0.60, ["no actionable lower case"], False), (0.60, None, True),
])
def test_bypass(spark, prob, factors, expected):
    assert rows(spark, ("C", prob, factors, "High")).select(E.bypassed(F.col("denial_probability"), F.col("factors"))).first()[0] is expected


GOOD = {"claim_id": "C1", "disclaimer": "This is a statistical estimate.", "risk_description": "Missing authorization.", "recommended_action": "Get authorization."}
PLAIN = "This is a statistical estimate. Missing authorization. Get authorization."


def parse(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    return E.parse_completions(frame).orderBy("i").collect()


def spoiled(**changes):
    return json.dumps({k: v for k, v in (GOOD | changes).items() if v is not None})


def test_parsing(spark):
    clean = json.dumps(GOOD)
    got = parse(
        spark, clean, f"```json\n{clean}\n```", f"```\n{clean}", f"Note:\n{clean}\nBye", spoiled(claim_id=7), spoiled(recommended_action=None),
        spoiled(disclaimer="The claim will be denied."), spoiled(risk_description="Bad"), "no json", "", None, "  \n ",
        spoiled(extra=1), spoiled(claim_id="   "), spoiled(disclaimer="  An estimate only.  "), "[1, 2]", "```", spoiled(claim_id="Other"),
    )
    assert [r.parse_tier for r in got] == [
        "direct", "direct", "direct", "rescued", "template", "template", "template", "template", "template", "empty", "empty", "empty",
        "direct", "template", "direct", "template", "template", "direct",
    ]
    assert [r.json_ok for r in got][8:11] == [False, False, False] and got[15].json_ok
    assert got[0].parsed_text == got[3].parsed_text == PLAIN
    assert got[14].parsed_text.startswith("An estimate only. Missing")
    assert got[3].parse_errors == [K.NOTE_RESCUED]
    assert got[4].parse_errors == ["claim_id: text required", "Regex fallback: claim_id: text required"]
    assert got[8].parse_errors == ["not valid JSON"] and got[0].parse_errors == []


def answering():
    """A completion function by value: no reply for E, an error for BOOM."""
    good = dict(GOOD)

    def answer(prompts: pd.Series) -> pd.DataFrame:
        ids = prompts.str.extract(r"Claim ID: (\S+)", expand=False)
        if (ids == "BOOM").any():
            raise RuntimeError("no connection")
        raw = ["" if i == "E" else json.dumps(good | {"claim_id": i}) for i in ids]
        return pd.DataFrame({"responded": True, "raw": raw, "prompt_tokens": 10, "completion_tokens": 5, "total_duration_ns": 2_500_000})

    return answer


def test_only_routed_rows_are_completed_and_failures_fall_back(spark):
    scored = rows(spark, ("A", 0.9, [AUTH], "High"), ("E", 0.9, [AUTH], "High"), ("M", 0.9, [AUTH], "Medium"), ("N", 0.9, [K.NO_FLAGS], "High"), ("L", 0.1, [AUTH], "Low"))
    explained = E.explain(scored, completion=answering())
    got = {r.claim_id: r for r in explained.collect()}
    assert {k for k, r in got.items() if r.responded is not None} == {"A", "E"}
    assert got["A"].explanation == PLAIN and got["E"].explanation.startswith("This claim has an estimated")
    log = {r.claim_id: r for r in U.records(explained, "m").collect()}
    assert log["A"].fallback_reason is None and (log["A"].total_tokens, log["A"].total_duration_ms, log["A"].eval_duration_ms) == (15, 2, None)
    assert (log["E"].fallback_reason, log["E"].api_error, log["E"].is_from_api) == (K.REASON_EMPTY, K.ERROR_EMPTY, True)
    assert log["E"].quality_warnings == ["Empty response text"]
    assert log["M"].fallback_reason == K.REASON_TEMPLATE and log["N"].fallback_reason == log["L"].fallback_reason == K.REASON_BYPASS
    failed = U.records(E.explain(rows(spark, ("BOOM", 0.9, [AUTH], "High")), completion=answering()), "m").first()
    assert (failed.api_error, failed.is_from_api, failed.response_length_chars) == (K.ERROR_FAILED, False, 0)


def test_without_completions_every_row_takes_the_template(spark):
    got = E.explain(rows(spark, ("A", 0.9, [AUTH], "High"))).first()
    assert got.use_api is False and got.explanation.startswith("This claim has an estimated denial risk of 90%")


def quality(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(U.quality(F.col("t")).alias("q")).first().q


def test_quality(spark):
    good = quality(spark, "This is an estimate. Please verify the authorization before you send it.")
    assert (good.has_disclaimer, good.has_action, good.min_length_ok, good.quality_warnings) == (True, True, True, [])
    bad = quality(spark, "Code icd-10 for the Patient Name.")
    assert bad.quality_warnings == [
        "No uncertainty disclaimer found", "No corrective action suggestion found", "Response too short: 33 chars",
        'Potential PII/hallucination: "ICD-"', 'Potential PII/hallucination: "patient name"',
    ]
    assert quality(spark, None).quality_warnings == quality(spark, "").quality_warnings == ["Empty response text"]


def test_audit_tables(spark, tmp_path):
    scored = rows(spark, ("A", 0.9, [AUTH], "High"), ("L", 0.1, [AUTH], "Low"))
    log = U.records(E.explain(scored, completion=answering()), "m")
    assert log.columns == U.RECORD_SCHEMA.names
    path = str(tmp_path / "audit")
    stores.write_audit(log, path, "r1")
    assert stores.read_audit(spark, path).count() == 2
    head = spark.read.parquet(f"{path}/headers").first()
    assert (head.total_calls, head.api_calls, head.fallbacks, head.total_tokens, head.disclaimer_rate, head.avg_latency_ms) == (2, 1, 1, 15, 1.0, 2.0)


def test_summaries_of_no_records(spark):
    empty = spark.createDataFrame([], U.RECORD_SCHEMA)
    assert U.token_summary(empty).first().total_tokens == 0
    assert U.quality_summary(empty).first().avg_latency_ms == 0.0


def test_nested_audit_files(spark, tmp_path):
    record = {"call_id": "c", "claim_id": "A", "risk_factors": ["x"], "total_tokens": 7}
    Path(tmp_path, "audit_1.json").write_text(json.dumps({"run_id": "1", "total_calls": 1, "records": [record]}, indent=2))
    Path(tmp_path, "audit_2.json").write_text(json.dumps({"run_id": "2", "total_calls": 1, "token_summary": {"total_tokens": 7}, "records": [record]}, indent=2))
    got = {r.run_id: r for r in stores.read_audit_files(spark, str(tmp_path)).collect()}
    assert got["1"].token_summary is None and got["2"].token_summary.total_tokens == 7
    assert got["1"].record.risk_factors == ["x"]


def test_one_bad_prompt_fails_alone(spark):
    def reply(prompts):
        if (prompts == "bad").any():
            raise RuntimeError("refused")
        return pd.DataFrame({"responded": [True] * len(prompts)})

    rows = spark.createDataFrame([(i, "bad" if i == 3 else "fine") for i in range(8)], "i int, prompt string").coalesce(1)
    got = {r["i"]: r["responded"] for r in E.complete(rows, reply).collect()}
    assert got == {i: i != 3 for i in range(8)}
