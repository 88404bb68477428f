"""Queries: requests, prompts, completions, parsing, audit records and summaries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators import audit as U
from riskledger.operators import explain as E
from riskledger.plans.catalog.base import SCORECARD, TABLES, add, card_scores, current_claims, quoted, tiered
from riskledger.plans.review import publish, score_with_card
from riskledger.sources import stores
from riskledger.streaming.audit import windowed_summary
from riskledger.streaming.review import store_stream
from riskledger.workspace import fresh_path

MODEL = "stub-writer"
STAMP = "2024-01-01T00:00:00+00:00"

# --- completions derived from the claims --------------------------------------------------------
# Every kind of answer a model may give, chosen by the claim number.  The text is SQL that both
# engines read alike.


def _answer(claim: str = "'\"' || claim_id || '\"'", disclaimer: str = "This is a statistical estimate, not a guaranteed outcome.",
            risk: str = "' || factor || ' is the main concern.", action: str | None = "Verify the record before submission.", extra: str = "") -> str:
    tail = "" if action is None else f', "recommended_action": "{action}"'
    return f"""('{{"claim_id": ' || {claim} || ', "disclaimer": "{disclaimer}", "risk_description": "{risk}"{tail}{extra}}}')"""


RAW_SQL = f"""CASE kind
  WHEN 0 THEN {_answer()}
  WHEN 1 THEN '```json' || chr(10) || {_answer()} || CASE WHEN k % 24 = 13 THEN '' ELSE chr(10) || '```' END
  WHEN 2 THEN 'Here is the note:' || chr(10) || {_answer()} || chr(10) || 'Regards'
  WHEN 3 THEN {_answer(claim="CAST(k AS VARCHAR(20))")}
  WHEN 4 THEN {_answer(action=None)}
  WHEN 5 THEN {_answer(disclaimer="The claim will be denied.")}
  WHEN 6 THEN {_answer(disclaimer="estimate", risk="Bad")}
  WHEN 7 THEN 'Sorry, I cannot help with this claim.'
  WHEN 8 THEN ''
  WHEN 9 THEN NULL
  WHEN 10 THEN {_answer(extra=', "confidence": 0.5')}
  ELSE {_answer(disclaimer="  A probability only. ", risk="CPT mismatch for the patient name.", action="Check ICD-10 coding.")} END"""
COMPLETION_SQL = f"""claim_id, factor, k, kind, kind <> 9 AS responded, {RAW_SQL} AS raw,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 300 + k % 100 END AS prompt_tokens, 50 + k % 50 AS completion_tokens,
  CASE WHEN k % 6 = 0 THEN 0 WHEN k % 6 = 1 THEN NULL ELSE k * 123457 + 1000000 END AS total_duration_ns,
  CASE WHEN k % 4 = 0 THEN NULL ELSE k * 54321 END AS eval_duration_ns"""


def completions_of(scored: DataFrame) -> DataFrame:
    """One derived completion per scored claim."""
    numbered = scored.selectExpr(K.KEY, "factors[0] AS factor", "CAST(substr(claim_id, 6) AS BIGINT) AS k")
    return numbered.selectExpr("*", "CAST(k % 12 AS INT) AS kind").selectExpr(*_split_items(COMPLETION_SQL))


def _split_items(text: str) -> list[str]:
    """Top-level comma-separated items of a SELECT list."""
    items, depth, inside, start = [], 0, False, 0
    for i, ch in enumerate(text):
        if ch == "'":
            inside = not inside
        elif not inside:
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                items.append(text[start:i].strip())
                start = i + 1
    return [*items, text[start:].strip()]


def _scores(spark, folder) -> DataFrame:
    return score_with_card(current_claims(spark, folder), SCORECARD)


def _completions(spark, folder) -> DataFrame:
    return completions_of(_scores(spark, folder))


def _prepared(spark, folder) -> DataFrame:
    return E.prepare(tiered(spark, folder))


def _explained(spark, folder) -> DataFrame:
    ranked = tiered(spark, folder)
    return E.explain(ranked, completions=completions_of(ranked))


def _records(spark, folder) -> DataFrame:
    return U.records(_explained(spark, folder), MODEL, at=F.lit(STAMP))


# --- SQL tables ---------------------------------------------------------------------------------

_ACTION_MAP = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in K.ACTIONS.items()) + "}"


def _action_sql(factor: str) -> str:
    return f"coalesce(map_extract({_ACTION_MAP}, {factor})[1], {quoted(K.DEFAULT_ACTION)})"


REQUESTS_SQL = f"""
SELECT *, replace(replace(replace(replace({quoted(K.PROMPT)}, '{{claim_id}}', claim_id), '{{probability}}', CAST(p3 AS VARCHAR)),
    '{{label}}', label), '{{factors}}', listed) AS prompt,
  'This claim has an estimated denial risk of ' || CAST(CAST(round_even(p3 * 100, 0) AS INTEGER) AS VARCHAR)
    || '% - this is a statistical estimate, not a guaranteed outcome.' AS t_disclaimer,
  CASE WHEN flagless THEN 'No actionable pre-submission risk flags are evident based on available data.'
    ELSE 'A key concern is that ' || regexp_replace(lower(factors[1]), '\\.+$', '') || '.' END AS t_risk,
  CASE WHEN flagless THEN 'Routine submission with standard verification is recommended.'
    ELSE 'Recommended action: ' || first_action END AS t_action,
  risk_tier = 'High' AND NOT bypass AS use_api
FROM (SELECT *, round_even(prob, 3) AS p3,
    CASE WHEN prob >= 0.5e0 THEN 'High' WHEN prob >= 0.25e0 THEN 'Medium' ELSE 'Low' END AS label,
    array_to_string(list_transform(factors, lambda f, i: '  ' || CAST(i AS VARCHAR) || '. ' || f || chr(10) || '     Fact: ' || f
      || chr(10) || '     Recommended action: ' || {_action_sql("f")}), chr(10)) AS listed,
    {_action_sql("factors[1]")} AS first_action,
    contains(lower(array_to_string(factors, '|')), 'no actionable') AS flagless,
    contains(array_to_string(factors, '|'), 'No actionable') OR contains(array_to_string(factors, '|'), 'No major') OR prob < 0.25e0 AS bypass
  FROM tiered) AS r
"""
COMPLETIONS_SQL = f"""SELECT {COMPLETION_SQL} FROM (
  SELECT *, CAST(k % 12 AS INTEGER) AS kind FROM (SELECT claim_id, factors[1] AS factor, CAST(substr(claim_id, 6) AS BIGINT) AS k FROM picked) AS a) AS b"""


def _field(source: str, name: str) -> str:
    return f"CASE WHEN json_type({source}, '$.{name}') = 'VARCHAR' THEN json_extract_string({source}, '$.{name}') END"


def _bad(prefix: str) -> str:
    rules = []
    for name, least in (("claim_id", 0), ("disclaimer", 10), ("risk_description", 5), ("recommended_action", 5)):
        rules.append(f"CASE WHEN {prefix}_{name} IS NULL THEN '{name}: text required' END")
        if least:
            rules.append(f"CASE WHEN length({prefix}_{name}) < {least} THEN '{name}: shorter than {least}' END")
    said = f"lower({prefix}_disclaimer)"
    phrases = ("estimate", "not a guarantee", "statistical", "may not", "does not guarantee", "not guaranteed", "probability")
    rules.append("CASE WHEN NOT (" + " OR ".join(f"contains({said}, '{p}')" for p in phrases) + ") THEN 'disclaimer: uncertainty qualifier required' END")
    rules.append(f"CASE WHEN trim({prefix}_claim_id) = '' THEN 'claim_id: blank' END")
    return f"CASE WHEN {prefix} IS NULL THEN ['not valid JSON'] ELSE list_filter([{', '.join(rules)}], lambda x: x IS NOT NULL) END"


def _paragraph(prefix: str) -> str:
    return f"trim({prefix}_disclaimer) || ' ' || {prefix}_risk_description || ' ' || {prefix}_recommended_action"


_FIELDS = ("claim_id", "disclaimer", "risk_description", "recommended_action")
PARSED_SQL = f"""
SELECT *, CASE WHEN NOT usable THEN 'empty' WHEN len(d_bad) = 0 THEN 'direct' WHEN len(r_bad) = 0 THEN 'rescued' ELSE 'template' END AS parse_tier,
  usable AND (d IS NOT NULL OR r IS NOT NULL) AS json_ok,
  CASE WHEN NOT usable THEN NULL WHEN len(d_bad) = 0 THEN {_paragraph("d")} WHEN len(r_bad) = 0 THEN {_paragraph("r")} END AS parsed_text,
  CASE WHEN NOT usable OR len(d_bad) = 0 THEN '' WHEN len(r_bad) = 0 THEN 'Regex extraction after JSON parse failure'
    ELSE array_to_string(d_bad, ', ') || CASE WHEN found <> '' THEN '; Regex fallback: ' || array_to_string(r_bad, ', ') ELSE '' END END AS parse_errors
FROM (SELECT *, {_bad("d")} AS d_bad, {_bad("r")} AS r_bad
  FROM (SELECT *, {", ".join(f"{_field('d', n)} AS d_{n}" for n in _FIELDS)}, {", ".join(f"{_field('r', n)} AS r_{n}" for n in _FIELDS)}
    FROM (SELECT *, CASE WHEN json_valid(cleaned) THEN cleaned END AS d, CASE WHEN found <> '' AND json_valid(found) THEN found END AS r,
        coalesce(length(regexp_replace(raw, '\\s', '', 'g')) > 0, false) AS usable
      FROM (SELECT *, coalesce(regexp_extract(raw, '\\{{[^{{}}]*"claim_id"[^{{}}]*\\}}', 0, 's'), '') AS found,
          CASE WHEN starts_with(bare, '```') THEN trim(regexp_replace(regexp_replace(bare, '^```[^\\n]*\\n', ''), '(^|\\n)[ \\t]*```[ \\t]*$', '')) ELSE bare END AS cleaned
        FROM (SELECT *, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS bare FROM completions) AS a) AS b) AS c) AS e) AS f
"""
EXPLAINED_SQL = """
SELECT *, t_disclaimer || ' ' || t_risk || ' ' || t_action AS template_text, t_disclaimer || ' ' || t_risk || ' ' || t_action AS explanation FROM requests
"""
WRITTEN_SQL = """
SELECT q.claim_id, q.rank, q.risk_tier, q.prob, q.p3, q.label, q.factors, q.prompt, q.bypass, q.use_api, p.responded, p.parse_tier, p.json_ok, p.parse_errors,
  p.prompt_tokens, p.completion_tokens, p.total_duration_ns, p.eval_duration_ns,
  CASE WHEN q.use_api AND p.parsed_text <> '' THEN p.parsed_text ELSE q.template_text END AS explanation
FROM explained AS q JOIN parsed AS p USING (claim_id)
"""


def _quality_sql(text: str) -> tuple[str, str, str, str]:
    low = f"lower({text})"
    has = lambda words: "(" + " OR ".join(f"contains({low}, {quoted(w.lower())})" for w in words) + ")"
    disclaimer = has(("estimate", "statistical", "not guaranteed", "not a guarantee"))
    action = has(("recommend", "verify", "obtain", "review", "attached", "confirm", "resolve", "correct", "submit", "ensure", "check"))
    leaks = ", ".join(
        f"CASE WHEN contains({low}, {quoted(m.lower())}) THEN 'Potential PII/hallucination: \"{m}\"' END"
        for m in ("ICD-", "CPT", "diagnosis code", "procedure code", "patient name", "SSN", "DOB", "date of birth")
    )
    warnings = f"""CASE WHEN {text} = '' THEN 'Empty response text' ELSE array_to_string(list_filter([
      CASE WHEN NOT {disclaimer} THEN 'No uncertainty disclaimer found' END, CASE WHEN NOT {action} THEN 'No corrective action suggestion found' END,
      CASE WHEN length({text}) < 50 THEN 'Response too short: ' || CAST(length({text}) AS VARCHAR) || ' chars' END, {leaks}], lambda x: x IS NOT NULL), ' | ') END"""
    return f"({text} <> '' AND {disclaimer})", f"({text} <> '' AND {action})", f"(length({text}) >= 50)", warnings


_D, _A, _L, _W = _quality_sql("said")
LOG_SQL = f"""
SELECT claim_id || CASE WHEN bypass THEN '_bypass_' WHEN NOT use_api THEN '_template_' ELSE '_' END || substr(md5(claim_id || '|' || prompt), 1, 8) AS call_id,
  claim_id, length(prompt) AS prompt_length_chars, substr(md5(prompt), 1, 12) AS prompt_hash,
  CASE WHEN use_api THEN p3 ELSE prob END AS denial_probability, label AS risk_tier, array_to_string(factors, ' | ') AS risk_factors,
  length(said) AS response_length_chars, substr(said, 1, 500) AS response_text,
  use_api AND (parse_tier <> 'empty' OR responded) AS is_from_api,
  CASE WHEN bypass THEN 'Low-risk bypass (prob < 0.25 or no actionable flags)' WHEN NOT use_api THEN 'Deterministic template (use_api=False, prob >= 0.25)'
    WHEN parse_tier = 'empty' THEN 'API returned empty or failed'
    WHEN parse_tier = 'template' THEN 'JSON/Pydantic validation failed: ' || parse_errors END AS fallback_reason,
  CASE WHEN use_api AND responded THEN prompt_tokens END AS prompt_tokens, CASE WHEN use_api AND responded THEN completion_tokens END AS completion_tokens,
  CASE WHEN use_api AND responded THEN prompt_tokens + completion_tokens END AS total_tokens,
  CASE WHEN use_api AND responded THEN nullif(total_duration_ns, 0) // 1000000 END AS total_duration_ms,
  CASE WHEN use_api AND responded THEN nullif(eval_duration_ns, 0) // 1000000 END AS eval_duration_ms,
  use_api AND json_ok AS json_parse_success, use_api AND parse_tier IN ('direct', 'rescued') AS pydantic_validation_success,
  CASE WHEN use_api THEN parse_errors ELSE '' END AS validation_errors,
  {_D} AS has_disclaimer, {_A} AS has_action, {_L} AS min_length_ok, {_W} AS quality_warnings,
  CASE WHEN use_api AND parse_tier = 'empty' THEN CASE WHEN responded THEN 'Empty API response' ELSE 'API call failed' END END AS api_error
FROM (SELECT *, CASE WHEN use_api AND parse_tier = 'empty' THEN '' ELSE explanation END AS said FROM written) AS w
"""
TABLES |= {
    "requests": (REQUESTS_SQL, ("tiered",)),
    "completions": (COMPLETIONS_SQL, ("picked",)),
    "parsed": (PARSED_SQL, ("completions",)),
    "explained": (EXPLAINED_SQL, ("requests",)),
    "written": (WRITTEN_SQL, ("explained", "parsed")),
    "log": (LOG_SQL, ("written",)),
}

# --- requests and templates ---------------------------------------------------------------------


def xp_request(spark, folder) -> DataFrame:
    rows = _scores(spark, folder).select(E.request(F.col(K.KEY), F.col("denial_probability"), F.col("factors")).alias("r"))
    joined = lambda part: F.array_join(F.transform("r.top_risk_factors", lambda f: f[part]), " | ")
    return rows.select(
        "r.claim_id", "r.denial_probability", "r.risk_estimate_label", joined("factor").alias("factors"),
        joined("fact").alias("facts"), joined("permitted_action").alias("actions"),
    )


_ACTIONS = f"array_to_string(list_transform(factors, lambda f: {_action_sql('f')}), ' | ')"
add("xp_request", xp_request, f"""SELECT claim_id, p3 AS denial_probability, label AS risk_estimate_label, array_to_string(factors, ' | ') AS factors,
  array_to_string(factors, ' | ') AS facts, {_ACTIONS} AS actions FROM requests""")


def xp_request_validate(spark, folder) -> DataFrame:
    """Requests made faulty in turn: shifted probabilities, an unknown label, six factors, an empty one."""
    rows = _scores(spark, folder).withColumn("k", F.substring(K.KEY, 6, 8).cast("long"))
    good = E.request(F.col(K.KEY), F.col("denial_probability"), F.col("factors"))
    item = lambda text: F.struct(F.lit(text).alias("factor"), F.lit(text).alias("fact"), F.lit("act").alias("permitted_action"))
    kind = F.col("k") % 5
    made = rows.withColumn("g", good).select(K.KEY, F.struct(
        F.col("g.claim_id").alias("claim_id"),
        F.when(kind == 1, F.col("g.denial_probability") + 1).otherwise(F.col("g.denial_probability")).alias("denial_probability"),
        F.when(kind == 2, F.lit("Critical")).otherwise(F.col("g.risk_estimate_label")).alias("risk_estimate_label"),
        F.when(kind == 3, F.array(*[item(f"Risk {i}") for i in range(6)])).when(kind == 4, F.array(item(""))).otherwise(F.col("g.top_risk_factors")).alias("top_risk_factors"),
    ).alias("r"))
    return made.select(K.KEY, F.array_join(E.request_violations(F.col("r")), " | ").alias("violations"))


add("xp_request_validate", xp_request_validate, """
SELECT claim_id, CASE CAST(substr(claim_id, 6) AS BIGINT) % 5 WHEN 1 THEN CASE WHEN p3 > 0 THEN 'denial_probability: outside 0..1' ELSE '' END
  WHEN 2 THEN 'risk_estimate_label: unknown' WHEN 3 THEN 'top_risk_factors: more than 5' WHEN 4 THEN 'top_risk_factors: empty text' ELSE '' END AS violations
FROM requests""")


def xp_prompt(spark, folder) -> DataFrame:
    rows = _scores(spark, folder).select(K.KEY, E.prompt(E.request(F.col(K.KEY), F.col("denial_probability"), F.col("factors"))).alias("prompt"))
    return rows.select(K.KEY, "prompt", F.substring(F.md5("prompt"), 1, 12).alias("prompt_hash"))


add("xp_prompt", xp_prompt, "SELECT claim_id, prompt, substr(md5(prompt), 1, 12) AS prompt_hash FROM requests")
add("xp_bypass", lambda spark, folder: _scores(spark, folder).select(K.KEY, E.bypassed(F.col("denial_probability"), F.col("factors")).alias("bypass")),
    "SELECT claim_id, bypass FROM requests")
add("xp_route", lambda spark, folder: _prepared(spark, folder).select(K.KEY, "risk_tier", "bypass", "use_api"),
    "SELECT claim_id, risk_tier, bypass, use_api FROM requests")


def xp_fallback(spark, folder) -> DataFrame:
    rows = _scores(spark, folder).withColumn("t", E.template_response(E.request(F.col(K.KEY), F.col("denial_probability"), F.col("factors"))))
    return rows.select("t.claim_id", "t.disclaimer", "t.risk_description", "t.recommended_action")


add("xp_fallback", xp_fallback, "SELECT claim_id, t_disclaimer AS disclaimer, t_risk AS risk_description, t_action AS recommended_action FROM requests")


def xp_plain_text(spark, folder) -> DataFrame:
    req = E.request(F.col(K.KEY), F.col("denial_probability"), F.col("factors"))
    return _scores(spark, folder).select(K.KEY, E.plain_text(E.template_response(req)).alias("text"))


add("xp_plain_text", xp_plain_text, "SELECT claim_id, template_text AS text FROM explained")

# --- completions and parsing --------------------------------------------------------------------


def stub_writer(action: str = "Review them first."):
    """A completion function that answers from the prompt alone.

    It is made inside a function so that it travels to the workers by value.
    """

    def write(prompts: pd.Series) -> pd.DataFrame:
        ids = prompts.str.extract(r"Claim ID: (\S+)", expand=False)
        raw = '{"claim_id": "' + ids + '", "disclaimer": "A statistical estimate only.", "risk_description": "See the listed facts.", "recommended_action": "' + action + '"}'
        return pd.DataFrame({
            "responded": True, "raw": raw, "prompt_tokens": prompts.str.len(), "completion_tokens": raw.str.len(),
            "total_duration_ns": prompts.str.len() * 1_000_000, "eval_duration_ns": None,
        })

    return write


def xp_complete(spark, folder) -> DataFrame:
    routed = _prepared(spark, folder).filter("use_api").select(K.KEY, "prompt")
    return E.complete(routed, stub_writer()).select(K.KEY, "responded", "raw", "prompt_tokens", "completion_tokens")


add("xp_complete", xp_complete, """
SELECT claim_id, true AS responded, raw, length(prompt) AS prompt_tokens, length(raw) AS completion_tokens FROM (
  SELECT claim_id, prompt, '{"claim_id": "' || claim_id || '", "disclaimer": "A statistical estimate only.", "risk_description": "See the listed facts.", "recommended_action": "Review them first."}' AS raw
  FROM requests WHERE use_api) AS r""")
def xp_complete_store(spark, folder) -> DataFrame:
    """A run over claims of even number, then one over all by another writer: stored replies stay, only missing calls are made."""
    routed, store = _prepared(spark, folder).filter("use_api").select(K.KEY, "prompt"), fresh_path(spark, "replies")
    E.complete(routed.filter(F.substring(K.KEY, -1, 1).cast("int") % 2 == 0), stub_writer(), store=store)
    done = E.complete(routed, stub_writer("Ask the payer first."), store=store)
    return done.select(K.KEY, "responded", "raw", "prompt_tokens", "completion_tokens", "completion_error")


add("xp_complete_store", xp_complete_store, """
SELECT claim_id, true AS responded, raw, length(prompt) AS prompt_tokens, length(raw) AS completion_tokens, CAST(NULL AS VARCHAR) AS completion_error FROM (
  SELECT claim_id, prompt, '{"claim_id": "' || claim_id || '", "disclaimer": "A statistical estimate only.", "risk_description": "See the listed facts.", "recommended_action": "'
    || CASE WHEN CAST(right(claim_id, 1) AS INTEGER) % 2 = 0 THEN 'Review them first.' ELSE 'Ask the payer first.' END || '"}' AS raw
  FROM requests WHERE use_api) AS r""")
add("xp_strip_fence", lambda spark, folder: _completions(spark, folder).select(K.KEY, E.strip_fence(F.col("raw")).alias("cleaned")),
    "SELECT claim_id, cleaned FROM parsed")


def xp_parse(spark, folder) -> DataFrame:
    rows = _completions(spark, folder).withColumn("v", E.parsed(E.strip_fence(F.col("raw")))).withColumn("f", E.response_fields(F.col("v")))
    return rows.select(K.KEY, F.col("v").isNotNull().alias("is_json"), F.col("f.claim_id").alias("said_id"), F.col("f.disclaimer").alias("disclaimer"))


add("xp_parse", xp_parse, "SELECT claim_id, d IS NOT NULL AS is_json, d_claim_id AS said_id, d_disclaimer AS disclaimer FROM parsed")


def xp_parse_rescue(spark, folder) -> DataFrame:
    rows = _completions(spark, folder).withColumn("found", F.coalesce(E.rescue_text(F.col("raw")), F.lit("")))
    return rows.select(K.KEY, "found", E.parsed(F.col("found")).isNotNull().alias("is_json"))


add("xp_parse_rescue", xp_parse_rescue, "SELECT claim_id, found, r IS NOT NULL AS is_json FROM parsed")


def xp_response_validate(spark, folder) -> DataFrame:
    rows = _completions(spark, folder).withColumn("v", E.parsed(E.strip_fence(F.col("raw"))))
    bad = F.when(F.col("v").isNull(), F.array(F.lit("not valid JSON"))).otherwise(E.response_violations(E.response_fields(F.col("v"))))
    return rows.select(K.KEY, F.array_join(bad, " | ").alias("violations"))


add("xp_response_validate", xp_response_validate, "SELECT claim_id, array_to_string(d_bad, ' | ') AS violations FROM parsed")


def xp_generate(spark, folder) -> DataFrame:
    return _explained(spark, folder).select(
        "rank", K.KEY, "risk_tier", "use_api", F.when(F.col("use_api"), F.col("parse_tier")).alias("parse_tier"), "explanation"
    )


add("xp_generate", xp_generate,
    "SELECT rank, claim_id, risk_tier, use_api, CASE WHEN use_api THEN parse_tier END AS parse_tier, explanation FROM written")

# --- audit --------------------------------------------------------------------------------------


def au_tokens(spark, folder) -> DataFrame:
    return _completions(spark, folder).select(
        K.KEY, "prompt_tokens", "completion_tokens", U.total_tokens(F.col("prompt_tokens"), F.col("completion_tokens")).alias("total_tokens")
    )


add("au_tokens", au_tokens, "SELECT claim_id, prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens FROM completions")


def au_latency(spark, folder) -> DataFrame:
    return _completions(spark, folder).select(
        K.KEY, U.milliseconds(F.col("total_duration_ns")).alias("total_duration_ms"), U.milliseconds(F.col("eval_duration_ns")).alias("eval_duration_ms")
    )


add("au_latency", au_latency, """SELECT claim_id, nullif(total_duration_ns, 0) // 1000000 AS total_duration_ms,
  nullif(eval_duration_ns, 0) // 1000000 AS eval_duration_ms FROM completions""")


def _checked(frame: DataFrame, *keys: str) -> DataFrame:
    rows = frame.withColumn("q", U.quality(F.col("text")))
    return rows.select(
        *keys, "q.has_disclaimer", "q.has_action", "q.min_length_ok", F.array_join("q.quality_warnings", " | ").alias("quality_warnings"),
        F.substring(F.md5("text"), 1, 12).alias("text_hash"), F.substring("text", 1, 500).alias("kept_text"),
    )


def _checked_sql(table: str, keys: str, where: str = "") -> str:
    d, a, n, w = _quality_sql("said")
    return f"""SELECT {keys}, {d} AS has_disclaimer, {a} AS has_action, {n} AS min_length_ok, {w} AS quality_warnings,
      substr(md5(said), 1, 12) AS text_hash, substr(said, 1, 500) AS kept_text FROM (SELECT *, text AS said FROM {table}) AS t {where}"""


add("au_quality", lambda spark, folder: _checked(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id"), _checked_sql("documents", "doc_id"))
add("au_quality_turns", lambda spark, folder: _checked(
    spark.read.parquet(f"{folder}/conversations.parquet").filter("role = 'assistant'"), "conv_id", "turn"),
    _checked_sql("conversations", "conv_id, turn", "WHERE role = 'assistant'"))

_LOG_COLUMNS = [c for c in U.RECORD_SCHEMA.names if c not in ("timestamp", "model")]
_LIST_COLUMNS = ("risk_factors", "quality_warnings")


def _flat(log: DataFrame) -> DataFrame:
    """Records with lists as text."""
    return log.select(*[
        F.array_join(c, " | ").alias(c) if c in _LIST_COLUMNS
        else F.array_join(c, "; ").alias(c) if c == "validation_errors"
        else F.round(c, 9).alias(c) if c == "denial_probability" else F.col(c)
        for c in _LOG_COLUMNS
    ])


_FLAT_SQL = ", ".join(f"round({c}, 9) AS {c}" if c == "denial_probability" else c for c in _LOG_COLUMNS)
add("au_record", lambda spark, folder: _flat(_records(spark, folder)), f"SELECT {_FLAT_SQL} FROM log")


def au_fallback_reason(spark, folder) -> DataFrame:
    return _records(spark, folder).groupBy("fallback_reason").agg(F.count("*").alias("claims"))


add("au_fallback_reason", au_fallback_reason, "SELECT fallback_reason, count(*) AS claims FROM log GROUP BY fallback_reason")
_TOKEN_SQL = """CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS total_prompt_tokens, CAST(coalesce(sum(completion_tokens), 0) AS BIGINT) AS total_completion_tokens,
  CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens"""
_COUNT_SQL = "count(*) AS total_calls, count(*) FILTER (is_from_api) AS api_calls, count(*) FILTER (fallback_reason IS NOT NULL) AS fallbacks"
_USED = "nullif(count(*) FILTER (is_from_api), 0)"
_RATE_SQL = f"""round(count(*) FILTER (is_from_api) / CAST(count(*) AS DOUBLE), 9) AS api_success_rate,
  round(coalesce(count(*) FILTER (is_from_api AND json_parse_success) / CAST({_USED} AS DOUBLE), 0e0), 9) AS json_parse_rate,
  round(coalesce(count(*) FILTER (is_from_api AND pydantic_validation_success) / CAST({_USED} AS DOUBLE), 0e0), 9) AS pydantic_pass_rate,
  round(count(*) FILTER (has_disclaimer) / CAST(count(*) AS DOUBLE), 9) AS disclaimer_rate,
  round(coalesce(sum(coalesce(total_duration_ms, 0)) FILTER (is_from_api) / CAST({_USED} AS DOUBLE), 0e0), 6) AS avg_latency_ms"""


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.select(*[
        F.round(c, 6 if c == "avg_latency_ms" else 9).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes
    ])


add("au_token_summary", lambda spark, folder: U.token_summary(_records(spark, folder)), f"SELECT {_TOKEN_SQL} FROM log")
add("au_quality_summary", lambda spark, folder: _rounded(U.quality_summary(_records(spark, folder), ["risk_tier"])),
    f"SELECT risk_tier, count(*) AS total_calls, {_RATE_SQL} FROM log GROUP BY risk_tier")
add("au_header", lambda spark, folder: U.header(_records(spark, folder), ["risk_tier"]), f"SELECT risk_tier, {_COUNT_SQL} FROM log GROUP BY risk_tier")

_DAY = 1_704_067_200


def _timed_records(spark, folder) -> DataFrame:
    """Records made seven seconds apart in the order of the claim numbers."""
    number = F.substring("claim_id", 6, 8).cast("long")
    return _records(spark, folder).withColumn("timestamp", F.date_format(F.timestamp_seconds(F.lit(_DAY) + 7 * number), "yyyy-MM-dd'T'HH:mm:ssxxx"))


def _hours(windows: DataFrame) -> DataFrame:
    hour = ((F.unix_timestamp("window_start") - _DAY) / 3600).cast("long")
    return _rounded(windows.withColumn("hour", hour).drop("window_start", "window_end"))


def au_window_summary(spark, folder) -> DataFrame:
    """Every hour of a stored log."""
    return _hours(windowed_summary(_timed_records(spark, folder)))


def au_window_stream(spark, folder) -> DataFrame:
    """The hours that a stream over the stored records has published when it has read them all."""
    source, target = fresh_path(spark, "records"), fresh_path(spark, "windows")
    _timed_records(spark, folder).write.parquet(source)
    windows = windowed_summary(spark.readStream.schema(U.RECORD_SCHEMA).parquet(source))
    store_stream(windows, target, fresh_path(spark, "progress")).awaitTermination()
    return _hours(spark.read.schema(windows.schema).parquet(target))


_HOURLY = f"""SELECT hour, risk_tier, {_COUNT_SQL}, {_TOKEN_SQL}, {_RATE_SQL} FROM (
  SELECT *, CAST(substr(claim_id, 6) AS BIGINT) * 7 // 3600 AS hour, max(CAST(substr(claim_id, 6) AS BIGINT) * 7) OVER () AS newest FROM log) AS l"""
add("au_window_summary", au_window_summary, f"{_HOURLY} GROUP BY hour, risk_tier")
add("au_window_stream", au_window_stream, f"{_HOURLY} WHERE (hour + 1) * 3600 <= newest - 600 GROUP BY hour, risk_tier")

# --- stored tables ------------------------------------------------------------------------------


def io_write_scored(spark, folder) -> DataFrame:
    path = fresh_path(spark, "scored")
    stores.write_scored(publish(E.explain(tiered(spark, folder))), path)
    return spark.read.parquet(path).withColumn("denial_probability", F.round("denial_probability", 9))


add("io_write_scored", io_write_scored, """SELECT rank, claim_id, round(prob, 9) AS denial_probability, predicted_denial, risk_tier,
  array_to_string(factors, ', ') AS top_risk_factors, explanation FROM explained""")


def io_write_audit(spark, folder) -> DataFrame:
    path = fresh_path(spark, "audit")
    stores.write_audit(_records(spark, folder), path, "run-1")
    return _rounded(spark.read.parquet(f"{path}/headers"))


add("io_write_audit", io_write_audit, f"SELECT 'run-1' AS run_id, {_COUNT_SQL}, {_TOKEN_SQL}, {_RATE_SQL} FROM log")


def io_read_audit(spark, folder) -> DataFrame:
    """Nested audit documents of at most 256 neighbouring claim numbers each, written and read back.

    Documents of even number lack the summaries, as older ones do.
    """
    log = _records(spark, folder).withColumn("run_id", F.floor(F.substring("claim_id", 6, 8).cast("long") / 256).cast("string"))
    documents = log.groupBy("run_id").agg(
        F.lit(STAMP).alias("generated_at"), F.count("*").alias("total_calls"),
        F.struct(F.sum("prompt_tokens").alias("total_prompt_tokens"), F.sum("completion_tokens").alias("total_completion_tokens"),
                 F.sum("total_tokens").alias("total_tokens")).alias("token_summary"),
        F.collect_list(F.struct(*U.RECORD_SCHEMA.names)).alias("records"),
    )
    odd = F.col("run_id").cast("long") % 2 == 1
    path = fresh_path(spark, "audit-files")
    documents.withColumn("token_summary", F.when(odd, F.col("token_summary"))).write.json(path)
    found = stores.read_audit_files(spark, path, one_per_file=False)
    return found.select("run_id", "total_calls", F.col("token_summary.total_tokens").alias("document_tokens"), "record.call_id",
                        "record.prompt_hash", "record.total_tokens", "record.is_from_api", F.array_join("record.risk_factors", " | ").alias("risk_factors"))


add("io_read_audit", io_read_audit, """
SELECT run_id, count(*) OVER w AS total_calls, CASE WHEN CAST(run_id AS BIGINT) % 2 = 1 THEN CAST(sum(total_tokens) OVER w AS BIGINT) END AS document_tokens,
  call_id, prompt_hash, total_tokens, is_from_api, risk_factors
FROM (SELECT *, CAST(CAST(substr(claim_id, 6) AS BIGINT) // 256 AS VARCHAR) AS run_id FROM log) AS l WINDOW w AS (PARTITION BY run_id)""")
