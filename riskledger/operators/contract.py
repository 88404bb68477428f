"""Data contract: rules as violation counts in a small report table.

A report has one row per rule: ``rule``, ``violations`` and ``passed``.  All counts of one table come
from a single aggregate; ids are compared with one semi join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators.ordering import order_breaks


class ContractError(AssertionError):
    """At least one contract rule failed."""


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("long")


def _count_gap(expected: int) -> Column:
    return F.abs(F.count(F.lit(1)) - F.lit(expected)).cast("long")


def _duplicates(key: str) -> Column:
    # Missing ids are not counted as distinct, so they break uniqueness as well.
    return (F.count(F.lit(1)) - F.count_distinct(F.col(key))).cast("long")


def _outside(column: str, allowed: Iterable) -> Column:
    value = F.col(column)
    return F.count_if(value.isNull() | ~value.isin(*allowed)).cast("long")


def _report(counts: DataFrame, rules: Iterable[str]) -> DataFrame:
    """One row of named counts -> one row per rule."""
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules])
    return counts.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)


def _literal_rows(df: DataFrame, found: Mapping[str, int]) -> DataFrame:
    """Rules settled by table metadata alone."""
    items = [F.struct(F.lit(r).alias("rule"), F.lit(int(n)).cast("long").alias("violations"))
             for r, n in found.items()]
    one = df.sparkSession.range(1).select(F.inline(F.array(*items)))
    return one.withColumn("passed", F.col("violations") == 0)


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _wanted(rules: Mapping[str, Column], only: Iterable[str] | None) -> dict[str, Column]:
    return {r: c for r, c in rules.items() if only is None or r in only}


def key_overlap(left: DataFrame, right: DataFrame, key: str = K.KEY) -> DataFrame:
    """Distinct ids that occur in both tables.

    Each side is reduced to its distinct ids first: repeated ids are combined before the shuffle, and
    the semi join reuses that shuffle's partitioning.
    """
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def missing_columns(required: Iterable[str], df: DataFrame) -> list[str]:
    return [c for c in required if c not in df.columns]


def check_inputs(
    history: DataFrame,
    current: DataFrame,
    expected_history: int | None = K.EXPECTED_HISTORY_ROWS,
    expected_current: int | None = K.EXPECTED_CURRENT_ROWS,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """The input rules; ``only`` limits the report (and the work) to some of them."""
    metadata = {
        "history_required_columns": len(missing_columns(K.REQUIRED_HISTORY, history)),
        "current_required_columns": len(missing_columns(K.REQUIRED_CURRENT, current)),
    }
    split, target = F.col(K.SPLIT), F.col(K.TARGET).cast("string")
    billed, expected = (F.col(c).try_cast("double") for c in ("total_billed", "expected_payment"))
    of_history: dict[str, Column] = {}
    of_current: dict[str, Column] = {}
    if expected_history is not None:
        of_history["history_row_count"] = _count_gap(expected_history)
    if expected_current is not None:
        of_current["current_row_count"] = _count_gap(expected_current)
    if K.KEY in history.columns:
        of_history["history_unique_key"] = _duplicates(K.KEY)
    if K.KEY in current.columns:
        of_current["current_unique_key"] = _duplicates(K.KEY)
    if K.SPLIT in history.columns:
        # Every expected value must occur and no other value may.
        absent = [F.when(F.count_if(split == v) == 0, 1).otherwise(0) for v in K.SPLITS]
        of_history["split_domain"] = (_outside(K.SPLIT, K.SPLITS) + sum(absent[1:], absent[0])).cast("long")
    if K.TARGET in history.columns:
        of_history["binary_target"] = F.count_if(target.isNull() | ~target.isin("0", "1")).cast("long")
    if {"total_billed", "expected_payment"} <= set(history.columns):
        # NaN compares as false here, as a missing amount does.
        of_history["payment_le_billed"] = F.count_if(
            ~F.isnan(expected) & ~F.isnan(billed) & (expected > billed)
        ).cast("long")

    parts = []
    for table, rules in ((history, of_history), (current, of_current)):
        rules = _wanted(rules, only)
        if rules:
            parts.append(_report(table.agg(*[c.alias(r) for r, c in rules.items()]), rules))
    if only is None or "key_overlap" in only:
        if K.KEY in history.columns and K.KEY in current.columns:
            shared = key_overlap(history, current).agg(F.count("*").alias("key_overlap"))
            parts.append(_report(shared, ["key_overlap"]))
    found = {r: n for r, n in metadata.items() if only is None or r in only}
    if found:
        parts.append(_literal_rows(history, found))
    return _stack(parts)


def check_outputs(
    scored: DataFrame,
    expected_rows: int | None = K.EXPECTED_CURRENT_ROWS,
    expected_tiers: Mapping[str, int] | None = None,
    rank: str = "rank",
    preview: int = 10,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """The output rules over a scored table.

    Row order is carried by ``rank``; every other column must be one of the six published ones, in
    order.  ``expected_tiers`` defaults to the published counts for the published row count.
    """
    if expected_tiers is None and expected_rows == K.EXPECTED_CURRENT_ROWS:
        expected_tiers = K.EXPECTED_TIER_ROWS
    shape = [c for c in scored.columns if c != rank]
    have = set(scored.columns)
    prob, tier, text = (F.col(c) for c in ("denial_probability", "risk_tier", "explanation"))
    blank = F.coalesce(text, F.lit("")) == ""
    rules: dict[str, Column] = {}
    if expected_rows is not None:
        rules["out_row_count"] = _count_gap(expected_rows)
    if K.KEY in have:
        rules["out_unique_key"] = _duplicates(K.KEY)
    if "denial_probability" in have:
        rules["out_prob_range"] = F.count_if(prob.isNull() | ~prob.between(0, 1)).cast("long")
    if "predicted_denial" in have:
        rules["out_binary_pred"] = _outside("predicted_denial", (0, 1))
    if "risk_tier" in have:
        rules["out_tier_domain"] = _outside("risk_tier", K.TIERS)
        for name, n in (expected_tiers or {}).items():
            rules[f"out_tier_count_{name.lower()}"] = F.abs(F.count_if(tier == name) - F.lit(n)).cast("long")
    if "explanation" in have:
        rules["out_preview_text"] = F.count_if((F.col(rank) <= preview) & blank).cast("long")
        rules["out_all_text"] = F.count_if(blank).cast("long")
    rules = _wanted(rules, only)
    parts = []
    if rules:
        parts.append(_report(scored.agg(*[c.alias(r) for r, c in rules.items()]), rules))
    if "denial_probability" in have and (only is None or "out_monotonic" in only):
        breaks = order_breaks(scored, rank, "denial_probability")
        parts.append(_report(breaks.withColumnRenamed("breaks", "out_monotonic"), ["out_monotonic"]))
    if only is None or "out_columns" in only:
        parts.append(_literal_rows(scored, {"out_columns": int(tuple(shape) != K.SCORED_COLUMNS)}))
    return _stack(parts)


def shortest_text_per_tier(scored: DataFrame) -> DataFrame:
    """Shortest explanation of every tier; zero means some row has no text."""
    length = F.length(F.coalesce(F.col("explanation"), F.lit("")))
    return scored.groupBy("risk_tier").agg(F.min(length).alias("min_chars"))


def enforce(report: DataFrame) -> None:
    """Raise when a rule of the report failed.  Only failed rules, at most one row each, are fetched."""
    failed = [f"{r.rule}: {r.violations}" for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise ContractError("; ".join(failed))


def validate_output(scored: DataFrame, **expectations) -> None:
    """Strict form of :func:`check_outputs`."""
    enforce(check_outputs(scored, **expectations))
