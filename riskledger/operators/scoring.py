"""Scores, global order, tiers and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.wording import feature_name, sql_number, sql_text
from riskledger.operators.ensembles import Sigmoid
from riskledger.operators.ordering import global_rank
from riskledger.workspace import stage_table


@dataclass(frozen=True)
class Scorecard:
    """A frozen linear model over raw feature columns: no fitted stage is needed to apply it.

    ``levels`` maps a category column to the weight of each level, ``numbers`` a numeric column to
    (mean, spread, weight).  Unknown levels add nothing.
    """

    intercept: float
    levels: Mapping[str, Mapping[str, float]]
    numbers: Mapping[str, tuple[float, float, float]]
    sigmoid: Sigmoid

    @property
    def names(self) -> list[str]:
        coded = [feature_name(c, level) for c, levels in self.levels.items() for level in levels]
        return coded + [feature_name(c) for c in self.numbers]

    def terms(self) -> str:
        """SQL text of the array of contributions, in the order of ``names``.

        Stated as text because a wide model is one expression to parse instead of hundreds of calls.
        """
        coded = [
            f"CASE WHEN `{c}` = {sql_text(level)} THEN {sql_number(w)} ELSE 0.0D END"
            for c, levels in self.levels.items()
            for level, w in levels.items()
        ]
        scaled = [
            f"{sql_number(w)} * ((CAST(`{c}` AS DOUBLE) - {sql_number(m)}) / {sql_number(s or 1.0)})"
            for c, (m, s, w) in self.numbers.items()
        ]
        return f"array({', '.join(coded + scaled)})"

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        """Adds ``contributions``, ``margin``, the raw probability and the calibrated one (``out``).

        The features are projected once into an array, which the margin is then added up from in
        order, so the result does not depend on how the plan is arranged.
        """
        margin = f"aggregate(contributions, {sql_number(self.intercept)}, (total, x) -> total + x)"
        return (
            df.withColumn("contributions", F.expr(self.terms()))
            .withColumn("margin", F.expr(margin))
            .withColumn("raw_prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
            .withColumn(out, self.sigmoid.of(F.col("margin")))
        )


def predicted(prob: Column, threshold: float | Column) -> Column:
    return (prob >= threshold).cast("int")


def risk_label(prob: Column) -> Column:
    """Label by probability alone; the tier, in contrast, depends on the rank."""
    return (
        F.when(prob >= K.LABEL_HIGH_FROM, F.lit("High"))
        .when(prob >= K.LABEL_MEDIUM_FROM, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def tier_of_rank(rank: Column, total: Column, high: float = 0.25, medium: float = 0.25) -> Column:
    """The first ``high`` share of ranks is High, the next ``medium`` share Medium, the rest Low."""
    return (
        F.when(rank <= F.floor(total * F.lit(high)), F.lit("High"))
        .when(rank <= F.floor(total * F.lit(high)) + F.floor(total * F.lit(medium)), F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def rank_and_tier(
    scored: DataFrame,
    threshold: float,
    prob: str = "denial_probability",
    key: str = K.KEY,
    high: float = K.REVIEW_CAPACITY,
    medium: float = 0.25,
) -> DataFrame:
    """Adds ``rank`` (probability descending, then id), ``predicted_denial`` and ``risk_tier``.

    Pass narrow rows: all columns of ``scored`` travel through the sort.  They are written first,
    because a range-partitioned sort reads its input twice (to sample the ranges and to move the
    rows) and the model should run once.
    """
    ranked = global_rank(stage_table(scored, "scores"), [F.desc(prob), F.asc(key)], total="_rows")
    return ranked.withColumns({
        "predicted_denial": predicted(F.col(prob), F.lit(float(threshold))),
        "risk_tier": tier_of_rank(F.col("rank"), F.col("_rows"), high, medium),
    }).drop("_rows")


def sorted_by_score(scored: DataFrame, prob: str = "denial_probability", key: str = K.KEY) -> DataFrame:
    """Total order over range partitions."""
    return scored.orderBy(F.desc(prob), F.asc(key))


def top_rows(scored: DataFrame, n: int = 3, prob: str = "denial_probability", key: str = K.KEY) -> DataFrame:
    """The ``n`` highest scores; each task keeps only its own best ``n`` rows."""
    return sorted_by_score(scored, prob, key).limit(n)


def claim_lookup(scored: DataFrame, claims: DataFrame, columns: Sequence[str], key: str = K.KEY) -> DataFrame:
    """Columns of the claim behind every scored row, by an equi-join on the unique id."""
    return scored.join(claims.select(key, *columns), key)
