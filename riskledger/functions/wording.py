"""Feature name -> reader-facing label.

A model has a few dozen feature names, so labels are worked out once per name on the driver and
shipped as a literal array; per-row work is then only an array lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskledger import constants as K

# Prefix of an encoded category -> how its label starts.
LIBRARY_PREFIXES = (
    ("payer_type_", "High-risk payer type: ", " "),
    ("visit_type_", "High-risk visit type: ", " "),
    ("payer_id_", "High-risk segment: Payer ID: ", " "),
    ("submission_delay_", "Submission Delay: ", "-"),
)

# Segment prefixes of the ordered rules.
SEGMENT_PREFIXES = (
    ("payer_type_", "Payer: "),
    ("visit_type_", "Visit: "),
    ("payer_id_", "Payer ID: "),
)

SKIP = object()

# Ordered rules, first match wins.  Each rule holds the exact names it takes, the
# alternatives of fragments it takes (all fragments of one alternative must occur), and its label.
ORDERED_RULES = (
    (("auth_gap",), (), "Missing Required Prior Authorization"),
    ((), (("missing_documentation_flag",), ("doc_issue",)), "Missing Supporting Documentation"),
    ((), (("referral_gap",),), "Missing Required Referral"),
    ((), (("eligibility_verified",), ("elig_issue",)), "Patient Eligibility Not Verified"),
    ((), (("is_in_network",), ("network", "issue")), "Provider Not in Payer Network"),
    (("days_to_submit",), (("late_filing",),), "Late Claim Submission (>30 days)"),
    ((), (("service_month",),), SKIP),
    ((), (("double_deficit",),), "Compound deficit: missing auth + documentation"),
    ((), (("total_admin_gaps",),), "Multiple administrative gaps"),
    ((), (("oon_auth_gap",),), "Out-of-network with missing authorization"),
    ((), (("oon_referral_gap",),), "Out-of-network with missing referral"),
    ((), (("is_high_risk_combo",),), "High-risk payer & visit combination"),
)


def _title(name: str) -> str:
    return name.replace("_", " ").title()


def friendly_label(name: str) -> str:
    """Label by exact name, then by category prefix, else the name in title case."""
    if name in K.FRIENDLY_LABELS:
        return K.FRIENDLY_LABELS[name]
    for prefix, start, joiner in LIBRARY_PREFIXES:
        if prefix in name:
            return start + name.replace(prefix, "").replace("_", joiner)
    return "Payer-Specific Risk Profile" if name == "payer_id" else _title(name)


def ordered_label(name: str, narrow_first: bool = False) -> str | None:
    """Label by the ordered rules; ``None`` means the feature is never shown.

    The rule for referral gaps takes ``oon_referral_gap`` too, so that label is shadowed;
    ``narrow_first=True`` tries the out-of-network rules before the general ones.
    """
    if any(prefix in name for prefix, _ in SEGMENT_PREFIXES):
        text = name
        for prefix, start in SEGMENT_PREFIXES:
            text = text.replace(prefix, start)
        return "High-risk segment: " + text.replace("_", " ")
    lowered = name.lower()
    rules = ORDERED_RULES
    if narrow_first:
        rules = sorted(rules, key=lambda rule: not any("oon_" in f for alt in rule[1] for f in alt))
    for exact, alternatives, label in rules:
        if lowered.strip() in exact or any(all(f in lowered for f in alt) for alt in alternatives):
            return None if label is SKIP else label
    return _title(name)


def sql_number(value: float) -> str:
    """A float as a SQL double literal."""
    return f"{float(value)!r}D"


def sql_text(value: str | None) -> str:
    """A SQL string literal, or a typed null."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Sequence[str | None]) -> Column:
    return F.expr(f"array({', '.join(sql_text(v) for v in values)})")


def number_array(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(sql_number(v) for v in values)})")


def label_array(names: Sequence[str], chooser=ordered_label) -> Column:
    """Literal array of labels in feature order; skipped features hold null."""
    return text_array([chooser(n) for n in names])


def action_for(factor: Column) -> Column:
    """Corrective action for a label, or the general advice."""
    pairs = ", ".join(f"{sql_text(label)}, {sql_text(action)}" for label, action in K.ACTIONS.items())
    return F.coalesce(F.element_at(F.expr(f"map({pairs})"), factor), F.lit(K.DEFAULT_ACTION))


def feature_name(column: str, level: str | None = None) -> str:
    """Name of a matrix column, with bracket and comparison signs made safe."""
    name = column if level is None else f"{column}_{level}"
    for sign in "[]<>":
        name = name.replace(sign, "_")
    return name
