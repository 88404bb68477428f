"""Audit records of explanations, text checks and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger import constants as K

_text = T.StringType()
RECORD_SCHEMA = T.StructType([
    T.StructField("call_id", _text),
    T.StructField("timestamp", _text),
    T.StructField("claim_id", _text),
    T.StructField("model", _text),
    T.StructField("prompt_length_chars", T.LongType()),
    T.StructField("prompt_hash", _text),
    T.StructField("denial_probability", T.DoubleType()),
    T.StructField("risk_tier", _text),
    T.StructField("risk_factors", T.ArrayType(_text)),
    T.StructField("response_length_chars", T.LongType()),
    T.StructField("response_text", _text),
    T.StructField("is_from_api", T.BooleanType()),
    T.StructField("fallback_reason", _text),
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
    T.StructField("total_tokens", T.LongType()),
    T.StructField("total_duration_ms", T.LongType()),
    T.StructField("eval_duration_ms", T.LongType()),
    T.StructField("json_parse_success", T.BooleanType()),
    T.StructField("pydantic_validation_success", T.BooleanType()),
    T.StructField("validation_errors", T.ArrayType(_text)),
    T.StructField("has_disclaimer", T.BooleanType()),
    T.StructField("has_action", T.BooleanType()),
    T.StructField("min_length_ok", T.BooleanType()),
    T.StructField("quality_warnings", T.ArrayType(_text)),
    T.StructField("api_error", _text),
])


def total_tokens(prompt: Column, completion: Column) -> Column:
    """Sum, or null unless both counts are known."""
    return prompt + completion


def milliseconds(nanoseconds: Column) -> Column:
    """Whole milliseconds; zero and missing durations are unknown."""
    return F.floor(F.nullif(nanoseconds, F.lit(0)) / 1_000_000)


def _mentions(text: Column, phrases) -> Column:
    lowered = F.lower(text)
    found = F.lit(False)
    for phrase in phrases:
        found = found | lowered.contains(phrase.lower())
    return found


def quality(text: Column) -> Column:
    """Checks of one text: three flags and the ordered warnings.

    Every phrase is a plain substring test on the whole text.
    """
    said = F.coalesce(text, F.lit(""))
    empty = said == ""
    disclaimer, action = _mentions(said, K.AUDIT_DISCLAIMERS), _mentions(said, K.AUDIT_ACTIONS)
    long_enough = F.length(said) >= K.MIN_RESPONSE_CHARS
    warnings = [
        F.when(~disclaimer, F.lit("No uncertainty disclaimer found")),
        F.when(~action, F.lit("No corrective action suggestion found")),
        F.when(~long_enough, F.concat(F.lit("Response too short: "), F.length(said).cast("string"), F.lit(" chars"))),
    ]
    for marker in K.LEAK_MARKERS:
        warnings.append(F.when(_mentions(said, [marker]), F.lit(f'Potential PII/hallucination: "{marker}"')))
    return F.struct(
        (~empty & disclaimer).alias("has_disclaimer"),
        (~empty & action).alias("has_action"),
        (~empty & long_enough).alias("min_length_ok"),
        F.when(empty, F.array(F.lit("Empty response text"))).otherwise(F.array_compact(F.array(*warnings))).alias("quality_warnings"),
    )


def fallback_reason() -> Column:
    """Why a row did not get a completed text; null when it did."""
    return (
        F.when(F.col("bypass"), F.lit(K.REASON_BYPASS))
        .when(~F.col("use_api"), F.lit(K.REASON_TEMPLATE))
        .when(F.col("parse_tier") == "empty", F.lit(K.REASON_EMPTY))
        .when(F.col("parse_tier") == "template", F.concat(F.lit(K.REASON_INVALID), F.array_join("parse_errors", "; ")))
    )


def call_id() -> Column:
    """Id of a call, fixed by claim and prompt, so a repeated task writes the same id."""
    kind = F.when(F.col("bypass"), F.lit("_bypass_")).when(~F.col("use_api"), F.lit("_template_")).otherwise(F.lit("_"))
    digest = F.substring(F.md5(F.concat(F.col("request.claim_id"), F.lit("|"), F.col("prompt"))), 1, 8)
    return F.concat(F.col("request.claim_id"), kind, digest)


def records(explained: DataFrame, model: str, at: Column | None = None) -> DataFrame:
    """One 26-column record per explained row (see :func:`riskledger.operators.explain.explain`)."""
    api, empty = F.col("use_api"), F.col("parse_tier") == "empty"
    answered = F.coalesce(F.col("responded"), F.lit(False))
    from_api = api & F.when(empty, answered).otherwise(F.lit(True))
    # A routed row without an answer is recorded with empty text, although the template is shown.
    text = F.when(api & empty, F.lit("")).otherwise(F.col("explanation"))
    stamp = at if at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    counted = lambda c: F.when(api & answered, c)
    checked = explained.withColumn("_text", text).withColumn("_q", quality(F.col("_text")))
    return checked.select(
        call_id().alias("call_id"),
        stamp.alias("timestamp"),
        F.col("request.claim_id").alias("claim_id"),
        F.lit(model).alias("model"),
        F.length("prompt").cast("long").alias("prompt_length_chars"),
        F.substring(F.md5(F.col("prompt")), 1, K.PROMPT_HASH_CHARS).alias("prompt_hash"),
        F.when(api, F.col("request.denial_probability")).otherwise(F.col("denial_probability")).alias("denial_probability"),
        F.col("request.risk_estimate_label").alias("risk_tier"),
        F.transform("request.top_risk_factors", lambda f: f["factor"]).alias("risk_factors"),
        F.length("_text").cast("long").alias("response_length_chars"),
        F.substring("_text", 1, K.AUDIT_TEXT_CHARS).alias("response_text"),
        from_api.alias("is_from_api"),
        fallback_reason().alias("fallback_reason"),
        counted(F.col("prompt_tokens")).alias("prompt_tokens"),
        counted(F.col("completion_tokens")).alias("completion_tokens"),
        counted(total_tokens(F.col("prompt_tokens"), F.col("completion_tokens"))).alias("total_tokens"),
        counted(milliseconds(F.col("total_duration_ns"))).alias("total_duration_ms"),
        counted(milliseconds(F.col("eval_duration_ns"))).alias("eval_duration_ms"),
        (api & F.col("json_ok")).alias("json_parse_success"),
        (api & F.col("valid")).alias("pydantic_validation_success"),
        F.when(api, F.col("parse_errors")).otherwise(F.array().cast("array<string>")).alias("validation_errors"),
        F.col("_q.has_disclaimer").alias("has_disclaimer"),
        F.col("_q.has_action").alias("has_action"),
        F.col("_q.min_length_ok").alias("min_length_ok"),
        F.col("_q.quality_warnings").alias("quality_warnings"),
        F.when(api & empty, F.when(answered, F.lit(K.ERROR_EMPTY)).otherwise(F.lit(K.ERROR_FAILED))).alias("api_error"),
    )


# --- summaries ----------------------------------------------------------------------------------

def _share(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def _token_sums() -> list[Column]:
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0))
    return [
        total("prompt_tokens").alias("total_prompt_tokens"),
        total("completion_tokens").alias("total_completion_tokens"),
        total("total_tokens").alias("total_tokens"),
    ]


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if("is_from_api").alias("api_calls"),
        F.count_if(F.coalesce(F.col("fallback_reason"), F.lit("")) != "").alias("fallbacks"),
    ]


def _rates() -> list[Column]:
    api = F.col("is_from_api")
    calls, used = F.count(F.lit(1)), F.count_if(api)
    waited = F.sum(F.when(api, F.coalesce(F.col("total_duration_ms"), F.lit(0))))
    return [
        _share(used, calls).alias("api_success_rate"),
        _share(F.count_if(api & F.col("json_parse_success")), used).alias("json_parse_rate"),
        _share(F.count_if(api & F.col("pydantic_validation_success")), used).alias("pydantic_pass_rate"),
        _share(F.count_if(F.col("has_disclaimer")), calls).alias("disclaimer_rate"),
        _share(F.coalesce(waited, F.lit(0)), used).alias("avg_latency_ms"),
    ]


def summary_columns() -> list[Column]:
    """All counts, sums and rates of a group of records; each can be kept up to date row by row."""
    return [*_counts(), *_token_sums(), *_rates()]


def event_time() -> Column:
    """When a record was made; null where its timestamp is none."""
    return F.try_to_timestamp(F.col("timestamp"))


def header(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*by).agg(*_counts())


def token_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Token sums; an unknown count adds nothing."""
    return log.groupBy(*by).agg(*_token_sums())


def quality_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rates; parse and schema rates and the mean latency are over API records only."""
    return log.groupBy(*by).agg(_counts()[0], *_rates())


def run_summary(log: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """All counts, sums and rates of a run in one row, from one aggregate."""
    return log.groupBy(*by).agg(*summary_columns())
