"""One explanation per row: request, prompt, completion, parsing with rescue, template.

All steps but the completion itself are column expressions.  Completions come from a callable the
user supplies; rows that need none never reach it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger import constants as K
from riskledger.functions.wording import action_for
from riskledger.operators.scoring import risk_label
from riskledger.workspace import fresh_path, stage_table

COMPLETION_SCHEMA = T.StructType([
    T.StructField("responded", T.BooleanType()),
    T.StructField("raw", T.StringType()),
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
    T.StructField("total_duration_ns", T.LongType()),
    T.StructField("eval_duration_ns", T.LongType()),
    T.StructField("completion_error", T.StringType()),
])
COMPLETION_COLUMNS = COMPLETION_SCHEMA.names
STORE_SCHEMA = T.StructType([T.StructField("call", T.StringType()), *COMPLETION_SCHEMA.fields])
CompletionFunction = Callable[[pd.Series], pd.DataFrame]


# --- request ------------------------------------------------------------------------------------

def request(claim_id: Column, prob: Column, factors: Column) -> Column:
    """The request record: id, probability to three places, label and factors with actions."""
    return F.struct(
        F.coalesce(claim_id.cast("string"), F.lit("UNKNOWN")).alias("claim_id"),
        F.bround(prob, 3).alias("denial_probability"),
        risk_label(prob).alias("risk_estimate_label"),
        F.transform(
            F.coalesce(factors, F.array().cast("array<string>")),
            lambda f: F.struct(
                f.alias("factor"), f.alias("fact"), action_for(f).alias("permitted_action")
            ),
        ).alias("top_risk_factors"),
    )


def _found(*rules: tuple[Column, str]) -> Column:
    """Texts of the rules that hold."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(text)) for rule, text in rules]))


def request_violations(req: Column) -> Column:
    """What is wrong with a request; empty when it is valid."""
    prob, label, factors = (req[c] for c in ("denial_probability", "risk_estimate_label", "top_risk_factors"))
    blank = lambda f: F.coalesce(f, F.lit("")) == ""
    incomplete = F.exists(factors, lambda x: blank(x["factor"]) | blank(x["fact"]) | blank(x["permitted_action"]))
    return _found(
        (req["claim_id"].isNull(), "claim_id: missing"),
        (prob.isNull() | F.isnan(prob) | ~prob.between(0, 1), "denial_probability: outside 0..1"),
        (label.isNull() | ~label.isin(*K.TIERS), "risk_estimate_label: unknown"),
        (factors.isNull(), "top_risk_factors: missing"),
        (F.size(factors) > K.MAX_FACTORS, f"top_risk_factors: more than {K.MAX_FACTORS}"),
        (incomplete, "top_risk_factors: empty text"),
    )


def _fill(template: str, **values: Column) -> Column:
    """Literal text with ``{name}`` places replaced by columns."""
    pieces: list[Column] = []
    rest = template
    while rest:
        spots = [(rest.find("{%s}" % n), n) for n in values if "{%s}" % n in rest]
        if not spots:
            pieces.append(F.lit(rest))
            break
        at, name = min(spots)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(values[name])
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces)


def prompt(req: Column) -> Column:
    """The prompt text of a request."""
    lines = F.array_join(
        F.transform(
            req["top_risk_factors"],
            lambda f, i: F.concat(
                F.lit("  "), (i + 1).cast("string"), F.lit(". "), f["factor"],
                F.lit("\n     Fact: "), f["fact"],
                F.lit("\n     Recommended action: "), f["permitted_action"],
            ),
        ),
        "\n",
    )
    listed = F.when(F.size(req["top_risk_factors"]) > 0, lines).otherwise(F.lit(K.PROMPT_NO_FACTORS))
    return _fill(
        K.PROMPT,
        claim_id=req["claim_id"],
        probability=req["denial_probability"].cast("string"),
        label=req["risk_estimate_label"],
        factors=listed,
    )


# --- routing ------------------------------------------------------------------------------------

def bypassed(prob: Column, factors: Column) -> Column:
    """No completion is wanted: no factors, a no-flag marker among them, or a low probability."""
    marked = F.exists(factors, lambda f: f.contains(K.BYPASS_MARKERS[0]) | f.contains(K.BYPASS_MARKERS[1]))
    return (F.coalesce(F.size(factors), F.lit(0)) <= 0) | F.coalesce(marked, F.lit(False)) | (prob < K.LOW_RISK_BELOW)


def routed(tier: Column, bypass: Column) -> Column:
    """Rows that go to the completion step."""
    return (tier == "High") & ~bypass


# --- template -----------------------------------------------------------------------------------

def template_response(req: Column) -> Column:
    """The deterministic response record."""
    percent = F.bround(req["denial_probability"] * 100, 0).cast("int").cast("string")
    factors = req["top_risk_factors"]
    flagless = (F.size(factors) <= 0) | F.exists(factors, lambda f: F.lower(f["factor"]).contains("no actionable"))
    fact = F.regexp_replace(F.lower(F.get(factors, F.lit(0))["fact"]), r"\.+$", "")
    action = F.get(factors, F.lit(0))["permitted_action"]
    return F.struct(
        req["claim_id"].alias("claim_id"),
        _fill(K.TEMPLATE_DISCLAIMER, percent=percent).alias("disclaimer"),
        F.when(flagless, F.lit(K.TEMPLATE_ROUTINE_RISK)).otherwise(_fill(K.TEMPLATE_CONCERN, fact=fact)).alias("risk_description"),
        F.when(flagless, F.lit(K.TEMPLATE_ROUTINE_ACTION)).otherwise(_fill(K.TEMPLATE_ACTION, action=action)).alias("recommended_action"),
    )


def plain_text(response: Column) -> Column:
    """Disclaimer, risk and action as one paragraph, empty parts left out."""
    parts = [F.nullif(response[c], F.lit("")) for c in ("disclaimer", "risk_description", "recommended_action")]
    return F.concat_ws(" ", *parts)


# --- completions --------------------------------------------------------------------------------

def _answered(rows: DataFrame, function: CompletionFunction, prompt_column: str, batch: int) -> DataFrame:
    """Rows with the completion columns, ``batch`` prompts a call."""
    schema = T.StructType([*rows.schema.fields, *COMPLETION_SCHEMA.fields])
    names = list(COMPLETION_COLUMNS)

    def answer(prompts: pd.Series) -> list[dict]:
        try:
            got = function(prompts.reset_index(drop=True)).astype(object)
            replies = got.where(got.notna(), None).to_dict("records")
            if len(replies) == len(prompts):
                return replies
            reason = f"{len(replies)} replies to {len(prompts)} prompts"
        except Exception as error:  # noqa: BLE001 - a failed call is data here
            reason = f"{type(error).__name__}: {error}"
        if len(prompts) > 1:  # one bad prompt fails alone
            return [r for i in range(len(prompts)) for r in answer(prompts.iloc[i:i + 1])]
        return [{"responded": False, "completion_error": reason}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            prompts = rows[prompt_column]
            replies = [r for i in range(0, len(rows), batch) for r in answer(prompts.iloc[i:i + batch])]
            columns = {n: pd.Series([r.get(n) for r in replies], index=rows.index, dtype=object) for n in names}
            columns["responded"] = columns["responded"].map(bool)
            yield rows.assign(**columns)

    return rows.mapInPandas(run, schema)


def complete(
    routed_rows: DataFrame,
    function: CompletionFunction,
    prompt_column: str = "prompt",
    lanes: int | None = None,
    batch: int = 32,
    store: str | None = None,
    calls_per_write: int = 50_000,
) -> DataFrame:
    """Adds the completion columns to rows that need one.

    ``function`` maps up to ``batch`` prompts to a frame with the completion columns; prompts of a failed
    batch are tried one at a time, and one that fails alone has no response but the reason in
    ``completion_error``.  ``lanes`` sets how many batches run at a time.
    The result is written once, so that later steps never repeat a call.  With ``store``, replies are kept there
    as well, and calls that it has a response to are not made (see :func:`complete_missing`).
    """
    if store is None:
        spread = routed_rows.repartition(lanes) if lanes else routed_rows
        return stage_table(_answered(spread, function, prompt_column, batch), "completions")
    named = routed_rows.withColumn("_call", call_key(F.col(K.KEY), F.col(prompt_column)))
    complete_missing(named.select("_call", prompt_column), function, store, prompt_column, lanes, batch, calls_per_write)
    replies = _one_reply(stored_completions(routed_rows.sparkSession, store), "call").withColumnRenamed("call", "_call")
    return stage_table(named.join(replies, "_call", "left").select(*routed_rows.columns, *COMPLETION_COLUMNS), "completions")


def call_key(claim_id: Column, prompt_text: Column) -> Column:
    """Name of a call: the same for the same claim and prompt, in every run."""
    return F.sha2(F.to_json(F.struct(claim_id.cast("string").alias("claim"), prompt_text.alias("prompt"))), 256)


def stored_completions(spark, store: str) -> DataFrame:
    """The replies kept in a store, which is made where there is none."""
    spark.createDataFrame([], STORE_SCHEMA).write.mode("ignore").parquet(store)
    return spark.read.schema(STORE_SCHEMA).parquet(store)


def complete_missing(
    calls: DataFrame,
    function: CompletionFunction,
    store: str,
    prompt_column: str = "prompt",
    lanes: int | None = None,
    batch: int = 32,
    calls_per_write: int = 50_000,
) -> None:
    """Makes the calls (``_call`` and a prompt) that the store holds no response to, and appends their replies.

    Repeated calls are made once.  About ``calls_per_write`` calls are one job that ends with its replies in the
    store: whatever fails later, a lost driver included, a rerun goes on behind the last such job.  A task that is
    tried again repeats its own share of one job.  A call without a response is made again in the next run, not in this.
    """
    spark = calls.sparkSession
    known = stored_completions(spark, store).filter("responded").select(F.col("call").alias("_call"))
    missing = stage_table(calls.dropDuplicates(["_call"]).join(known, "_call", "left_anti"), "calls")
    waves = -(-missing.count() // calls_per_write)
    if not waves:
        return
    waved = missing.withColumn("_wave", F.pmod(F.xxhash64("_call"), F.lit(waves)).cast("int"))
    path = fresh_path(spark, "waves")
    waved.repartition("_wave").write.partitionBy("_wave").parquet(path)
    for wave in range(waves):  # one job, not one row, a turn
        rows = spark.read.schema(waved.schema).parquet(path).filter(F.col("_wave") == wave).drop("_wave")
        spread = rows.repartition(lanes or spark.sparkContext.defaultParallelism)
        replies = _answered(spread, function, prompt_column, batch).drop(prompt_column)
        replies.withColumnRenamed("_call", "call").write.mode("append").parquet(store)


def strip_fence(text: Column) -> Column:
    """Text without surrounding blanks and without a Markdown code fence."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    opened = F.regexp_replace(bare, r"^```[^\n]*\n", "")
    closed = F.regexp_replace(opened, r"(^|\n)[^\S\n]*```[^\S\n]*$", "")
    return F.when(bare.startswith("```"), F.regexp_replace(closed, r"^\s+|\s+$", "")).otherwise(bare)


def rescue_text(raw: Column) -> Column:
    """The first brace-free object in the text that mentions a claim id; empty when there is none."""
    return F.regexp_extract(raw, r'(?s)\{[^{}]*"claim_id"[^{}]*\}', 0)


def parsed(text: Column) -> Column:
    """JSON value of a text, null when it is not JSON."""
    return F.try_parse_json(text)


def response_fields(value: Column) -> Column:
    """The four fields of a parsed response; a field of another type than text is null.

    Other keys are ignored.
    """
    def text(name: str) -> Column:
        found = F.try_variant_get(value, f"$.{name}", "variant")
        return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(value, f"$.{name}", "string"))

    return F.struct(*[text(n).alias(n) for n in K.RESPONSE_FIELDS])


def response_violations(fields: Column) -> Column:
    """What is wrong with a response; empty when it is valid."""
    rules = []
    for name, least in K.RESPONSE_FIELDS.items():
        rules.append((fields[name].isNull(), f"{name}: text required"))
        if least:
            rules.append((F.length(fields[name]) < least, f"{name}: shorter than {least}"))
    said = F.lower(fields["disclaimer"])
    qualified = F.lit(False)
    for phrase in K.DISCLAIMER_PHRASES:
        qualified = qualified | said.contains(phrase)
    rules.append((~qualified, "disclaimer: uncertainty qualifier required"))
    rules.append((F.regexp_replace(fields["claim_id"], r"^\s+|\s+$", "") == "", "claim_id: blank"))
    return _found(*rules)


def response_text(fields: Column) -> Column:
    """Paragraph of a valid response."""
    tidy = F.struct(
        F.regexp_replace(fields["disclaimer"], r"^\s+|\s+$", "").alias("disclaimer"),
        fields["risk_description"].alias("risk_description"),
        fields["recommended_action"].alias("recommended_action"),
    )
    return plain_text(tidy)


def parse_completions(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``parse_tier`` (direct, rescued or template), the text where there is one, and flags.

    Columns: ``json_ok``, ``valid``, ``parse_tier``, ``parsed_text`` and ``parse_errors``.
    """
    return (
        df.withColumn("_direct", parsed(strip_fence(F.col(raw))))
        .withColumn("_rescue", parsed(rescue_text(F.col(raw))))
        .withColumn("_direct_fields", response_fields(F.col("_direct")))
        .withColumn("_rescue_fields", response_fields(F.col("_rescue")))
        .withColumn("_direct_bad", F.when(F.col("_direct").isNull(), F.array(F.lit("not valid JSON"))).otherwise(response_violations(F.col("_direct_fields"))))
        .withColumn("_rescue_bad", F.when(F.col("_rescue").isNull(), F.array(F.lit("not valid JSON"))).otherwise(response_violations(F.col("_rescue_fields"))))
        .withColumn("_usable", F.coalesce(F.length(F.regexp_replace(F.col(raw), r"\s", "")) > 0, F.lit(False)))
        .withColumn("_has_rescue", F.length(rescue_text(F.col(raw))) > 0)
        .withColumn(
            "parse_tier",
            F.when(~F.col("_usable"), F.lit("empty"))
            .when(F.size("_direct_bad") == 0, F.lit("direct"))
            .when(F.size("_rescue_bad") == 0, F.lit("rescued"))
            .otherwise(F.lit("template")),
        )
        .withColumns({
            "json_ok": F.col("_usable") & (F.col("_direct").isNotNull() | F.col("_rescue").isNotNull()),
            "valid": F.col("parse_tier").isin("direct", "rescued"),
            "parsed_text": F.when(F.col("parse_tier") == "direct", response_text(F.col("_direct_fields")))
            .when(F.col("parse_tier") == "rescued", response_text(F.col("_rescue_fields"))),
            "parse_errors": F.when(F.col("parse_tier") == "rescued", F.array(F.lit(K.NOTE_RESCUED)))
            .when(
                F.col("parse_tier") == "template",
                F.array_compact(F.array(
                    F.array_join("_direct_bad", ", "),
                    F.when(F.col("_has_rescue"), F.concat(F.lit("Regex fallback: "), F.array_join("_rescue_bad", ", "))),
                )),
            )
            .otherwise(F.array().cast("array<string>")),
        })
        .drop("_direct", "_rescue", "_direct_fields", "_rescue_fields", "_direct_bad", "_rescue_bad", "_usable", "_has_rescue")
    )


# --- the whole step -----------------------------------------------------------------------------

def prepare(scored: DataFrame, prob: str = "denial_probability", factors: str = "factors", tier: str = "risk_tier") -> DataFrame:
    """Adds ``request``, ``prompt``, ``bypass`` and ``use_api`` to scored rows."""
    return (
        scored.withColumn("request", request(F.col(K.KEY), F.col(prob), F.col(factors)))
        .withColumn("prompt", prompt(F.col("request")))
        .withColumn("bypass", bypassed(F.col(prob), F.col(factors)))
        .withColumn("use_api", routed(F.col(tier), F.col("bypass")))
    )


def explain(
    scored: DataFrame,
    completion: CompletionFunction | None = None,
    completions: DataFrame | None = None,
    lanes: int | None = None,
    store: str | None = None,
) -> DataFrame:
    """Scored rows with their ``explanation`` and everything an audit record needs.

    Routed rows are completed by ``completion`` (replies are kept in and taken from ``store``, if named), or looked up in a ``completions`` table keyed by the
    claim id; without either, every row takes the template.  Routed rows are a separate branch, so
    the callable sees no other row.
    """
    ready = prepare(scored).withColumn("use_api", F.coalesce("use_api", F.lit(False)))
    if completion is None and completions is None:
        ready = ready.withColumn("use_api", F.lit(False))
    plain = ready.filter(~F.col("use_api"))
    for field in COMPLETION_SCHEMA.fields:
        plain = plain.withColumn(field.name, F.lit(None).cast(field.dataType))
    wide = plain
    if completion is not None:
        wide = plain.unionByName(complete(ready.filter("use_api"), completion, lanes=lanes, store=store))
    elif completions is not None:
        wide = plain.unionByName(
            ready.filter("use_api").join(one_per_claim(completions), K.KEY, "left")
        )
    return settle(wide)


def one_per_claim(completions: DataFrame) -> DataFrame:
    """One completion per claim: one that responded before one that did not, then the smallest by its fields.

    A table without the reasons of failed calls has none.
    """
    if "completion_error" not in completions.columns:
        completions = completions.withColumn("completion_error", F.lit(None).cast("string"))
    return _one_reply(completions, K.KEY)


def _one_reply(replies: DataFrame, key: str) -> DataFrame:
    best = F.struct((~F.coalesce("responded", F.lit(False))).alias("late"), *COMPLETION_COLUMNS)
    kept = replies.groupBy(key).agg(F.min(best).alias("_reply"))
    return kept.select(key, *[F.col("_reply")[c].alias(c) for c in COMPLETION_COLUMNS])


def settle(wide: DataFrame) -> DataFrame:
    """Final text per row from its completion columns: direct, rescued, else template."""
    template = plain_text(template_response(F.col("request")))
    return (
        parse_completions(wide)
        .withColumn("template_text", template)
        .withColumn("explanation", F.coalesce(F.nullif(F.col("parsed_text"), F.lit("")), F.col("template_text")))
    )
