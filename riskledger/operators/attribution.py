"""From feature contributions to readable risk factors.

Contributions are an array per row, labels a literal array per model, so every step is an array
function on one row: no shuffle, no join and no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.wording import action_for, friendly_label, label_array, number_array, ordered_label, text_array


def contributions(features: Column, coefficients: Sequence[float]) -> Column:
    """Coefficient times matrix value, per feature."""
    return F.zip_with(vector_to_array(features), number_array(coefficients), lambda x, w: x * w)


def _ranked_positive(contribs: Column) -> Column:
    """(minus contribution, position) of the positive entries, largest first, ties by position."""
    marked = F.transform(contribs, lambda c, i: F.struct((-c).alias("minus"), i.alias("at")))
    return F.sort_array(F.filter(marked, lambda s: s["minus"] < 0))


def top_factors(contribs: Column, names: Sequence[str], n: int = 3) -> Column:
    """The ``n`` largest positive contributions as (feature, contribution)."""
    feature = text_array(names)
    return F.transform(
        F.slice(_ranked_positive(contribs), 1, n),
        lambda s: F.struct(
            F.element_at(feature, s["at"] + 1).alias("feature"), (-s["minus"]).alias("contribution")
        ),
    )


def _flagless(labels: Column, prob: Column, low: float) -> Column:
    """``labels``, or the no-flag text for a low probability or an empty list."""
    none = F.array(F.lit(K.NO_FLAGS))
    return F.when((prob < low) | (F.size(labels) == 0), none).otherwise(labels)


def friendly_factors(prob: Column, contribs: Column, names: Sequence[str], n: int = 3, low: float = K.LOW_RISK_BELOW) -> Column:
    """Labels of the top ``n`` features; features that share a label leave fewer than ``n``."""
    labels = label_array(names, friendly_label)
    picked = F.transform(F.slice(_ranked_positive(contribs), 1, n), lambda s: F.element_at(labels, s["at"] + 1))
    return _flagless(F.array_distinct(picked), prob, low)


def ordered_factors(prob: Column, contribs: Column, names: Sequence[str], n: int = 3, low: float = K.LOW_RISK_BELOW) -> Column:
    """The first ``n`` distinct labels over all positive features, skipped features left out."""
    labels = label_array(names, ordered_label)
    every = F.transform(_ranked_positive(contribs), lambda s: F.element_at(labels, s["at"] + 1))
    return _flagless(F.slice(F.array_distinct(F.array_compact(every)), 1, n), prob, low)


def rule_factors(prob: Column, n: int = 3, low: float = K.LOW_RISK_BELOW) -> Column:
    """Factors from the claim's own flags, for models without coefficients."""
    # Order of the rules.
    rules = (
        (F.col("auth_gap") == 1, "Missing Required Prior Authorization"),
        (F.col("missing_documentation_flag") == 1, "Missing Supporting Documentation"),
        (F.col("eligibility_verified") == 0, "Patient Eligibility Not Verified"),
        (F.col("referral_gap") == 1, "Missing Required Referral"),
        (F.col("late_filing") == 1, "Late Claim Submission (>30 days)"),
        (F.col("is_in_network") == 0, "Provider Not in Payer Network"),
    )
    held = F.array_compact(F.array(*[F.when(rule, F.lit(label)) for rule, label in rules]))
    return _flagless(F.slice(held, 1, n), prob, low)


def factor_text(factors: Column) -> Column:
    return F.array_join(factors, ", ")


def factor_actions(factors: Column) -> Column:
    return F.transform(factors, action_for)
