"""Fixed values shared by the operators.

Everything in this module is data: column lists, default parameters, word lists and texts.  The
values are part of the results users see, so they are stated once, in plain form, and imported.
"""

# --- column roles -------------------------------------------------------------------------------
# Claim table columns by role.
KEY = "claim_id"
SPLIT = "split"
TARGET = "is_denied"
REASON = "denial_reason"
MONTH = "service_month"
NUMERIC = ("total_billed", "expected_payment", "num_procedures", "num_diagnoses", "days_to_submit")
FLAGS = (
    "prior_auth_required",
    "has_prior_auth",
    "is_in_network",
    "missing_documentation_flag",
    "eligibility_verified",
    "referral_required",
    "referral_present",
)
CATEGORIES = ("payer_type", "visit_type", "payer_id")
RAW_COLUMNS = (KEY, *CATEGORIES, *NUMERIC, *FLAGS, MONTH)
HISTORY_ONLY = (SPLIT, TARGET, REASON)
SPLITS = ("train", "validation", "test")
REQUIRED_HISTORY = (KEY, SPLIT, TARGET, REASON)
REQUIRED_CURRENT = (KEY,)
# Columns that must never reach a model.
NON_FEATURES = (KEY, SPLIT, REASON, MONTH, "service_month_dt")

SCORED_COLUMNS = (
    KEY,
    "denial_probability",
    "predicted_denial",
    "risk_tier",
    "top_risk_factors",
    "explanation",
)
TIERS = ("High", "Medium", "Low")

# --- derived feature columns --------------------------------------------------------------------
GAP_FLAGS = ("auth_gap", "referral_gap", "doc_issue", "elig_issue", "network_issue")
DERIVED = (
    "service_month_num",
    "service_quarter",
    "auth_gap",
    "referral_gap",
    "doc_issue",
    "elig_issue",
    "network_issue",
    "late_filing",
    "payment_ratio",
    "payment_gap",
    "log_total_billed",
    "log_expected_payment",
    "billed_per_procedure",
    "billed_per_diagnosis",
    "complexity_score",
    "total_admin_gaps",
    "oon_auth_gap",
    "oon_referral_gap",
    "double_deficit",
    "is_high_risk_combo",
    "submission_delay",
)
INTERACTIONS = ("billed_x_admin_gaps", "billed_x_doc_issue")
MODEL_NUMERIC = (*NUMERIC, *FLAGS, *DERIVED)

# --- numeric defaults ---------------------------------------------------------------------------
# Defaults that decide results.
SEED = 42
REVIEW_CAPACITY = 0.25
LATE_DAYS = 30
LOW_RISK_BELOW = 0.25
LABEL_HIGH_FROM = 0.5
LABEL_MEDIUM_FROM = 0.25
EXPECTED_HISTORY_ROWS = 3200
EXPECTED_CURRENT_ROWS = 500
EXPECTED_TIER_ROWS = {"High": 125, "Medium": 125, "Low": 250}
C_GRID = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
DELAY_EDGES = (0, 7, 14, 30, 60, 100)
# Names of the delay buckets, in order, for the text variant of the bucket column.
DELAY_NAMES = ("<1wk", "1-2wk", "2-4wk", "1-2mo", ">2mo")

# --- risk factor wording ------------------------------------------------------------------------
# Feature name -> label.
FRIENDLY_LABELS = {
    "auth_gap": "Missing Required Prior Authorization",
    "referral_gap": "Missing Required Referral",
    "missing_documentation_flag": "Missing Supporting Documentation",
    "eligibility_verified": "Patient Eligibility Not Verified",
    "is_in_network": "Provider Not in Payer Network",
    "late_filing": "Late Claim Submission (>30 days)",
    "days_to_submit": "Extended Days to Submit",
    "log_total_billed": "High Claim Billed Amount",
    "payment_ratio": "Low Expected Payment Ratio",
    "complexity_score": "High Claim Complexity",
    "service_month_num": "Service Month Factor",
    "total_admin_gaps": "Multiple Administrative Gaps",
    "oon_auth_gap": "Out-of-Network + Missing Authorization",
    "oon_referral_gap": "Out-of-Network + Missing Referral",
    "double_deficit": "Compound deficit: missing auth + documentation",
    "is_high_risk_combo": "High-risk payer & visit combination",
}

NO_FLAGS = "No actionable pre-submission risk flags detected"

# Label -> corrective action.
ACTIONS = {
    "Missing Required Prior Authorization":
        "Confirm whether the required prior authorization can be obtained and documented before submission.",
    "Missing Required Referral":
        "Obtain the required referral from the referring provider and attach it before submission.",
    "Missing Supporting Documentation":
        "Review and attach all required supporting clinical documentation before submission.",
    "Patient Eligibility Not Verified":
        "Run an eligibility verification check with the payer before submission.",
    "Provider Not in Payer Network":
        "Verify network status and confirm whether a network exception or prior authorization exists.",
    "Late Claim Submission (>30 days)":
        "Confirm the payer timely-filing deadline and gather any proof of original timely submission.",
    "Extended Days to Submit":
        "Expedite preparation and submission to avoid approaching timely-filing limits.",
    "High Claim Billed Amount":
        "Ensure all billed services are well documented and appropriately coded.",
    "Low Expected Payment Ratio":
        "Review the contract rate and verify coding accuracy for the expected payment level.",
    "High Claim Complexity":
        "Carefully review procedure-diagnosis alignment and ensure comprehensive documentation.",
    "Multiple Administrative Gaps":
        "Systematically resolve each administrative gap (authorization, documentation, eligibility, referral) before submission.",
    "Out-of-Network + Missing Authorization":
        "Verify network status simultaneously with confirming authorization availability before submission.",
    "Out-of-Network + Missing Referral":
        "Confirm network status and obtain the required referral before submission.",
    "Compound deficit: missing auth + documentation":
        "Resolve the missing authorization and attach all required documentation before submission.",
    "High-risk payer & visit combination":
        "Perform an enhanced pre-submission review due to the high-risk payer and visit type combination.",
}
DEFAULT_ACTION = (
    "Review the identified risk factors and take appropriate corrective action before submission."
)

# --- explanation texts --------------------------------------------------------------------------
# Template sentences; {percent}, {fact} and {action} are filled per row.
TEMPLATE_DISCLAIMER = (
    "This claim has an estimated denial risk of {percent}% - "
    "this is a statistical estimate, not a guaranteed outcome."
)
TEMPLATE_ROUTINE_RISK = (
    "No actionable pre-submission risk flags are evident based on available data."
)
TEMPLATE_ROUTINE_ACTION = "Routine submission with standard verification is recommended."
TEMPLATE_CONCERN = "A key concern is that {fact}."
TEMPLATE_ACTION = "Recommended action: {action}"

# Prompt wording; {claim_id}, {probability}, {label} and {factors} are filled per row.
PROMPT = """You are a revenue-cycle billing analyst writing pre-submission review notes.

Write a plain-English explanation for the following claim.
Return ONLY a valid JSON object. No other text before or after the JSON.
The JSON must have exactly these keys (all strings):

- "claim_id": "{claim_id}"
- "disclaimer": One sentence stating this is a statistical estimate, NOT a guaranteed denial outcome.
- "risk_description": One concise sentence describing the primary risk.
- "recommended_action": One concise sentence giving the single most actionable corrective step.

RULES:
- Use ONLY the risk facts and actions listed below. Do not invent new risks.
- Do NOT mention ICD/CPT codes, dollar amounts, or patient identifiers.
- Do NOT claim any action guarantees payment.
- The disclaimer MUST include qualifying language like "estimated" or "statistical".

Claim ID: {claim_id}
Estimated Denial Probability: {probability}
Risk Tier: {label}
Top Risk Factors:
{factors}

JSON response:"""
PROMPT_NO_FACTORS = "  (No actionable pre-submission risk flags detected)"

# Markers that switch the completion step off (case-sensitive).
BYPASS_MARKERS = ("No actionable", "No major")
# Phrases one of which a completed disclaimer must contain (any case).
DISCLAIMER_PHRASES = (
    "estimate",
    "not a guarantee",
    "statistical",
    "may not",
    "does not guarantee",
    "not guaranteed",
    "probability",
)
# Response fields and their minimum lengths.
RESPONSE_FIELDS = {
    "claim_id": 0,
    "disclaimer": 10,
    "risk_description": 5,
    "recommended_action": 5,
}
MAX_FACTORS = 5

# --- audit word lists ---------------------------------------------------------------------------
# Text quality checks.
AUDIT_DISCLAIMERS = ("estimate", "statistical", "not guaranteed", "not a guarantee")
AUDIT_ACTIONS = (
    "recommend",
    "verify",
    "obtain",
    "review",
    "attached",
    "confirm",
    "resolve",
    "correct",
    "submit",
    "ensure",
    "check",
)
LEAK_MARKERS = (
    "ICD-",
    "CPT",
    "diagnosis code",
    "procedure code",
    "patient name",
    "SSN",
    "DOB",
    "date of birth",
)
MIN_RESPONSE_CHARS = 50
AUDIT_TEXT_CHARS = 500
PROMPT_HASH_CHARS = 12

# Why a template was used, and what went wrong with a call.
REASON_EMPTY = "API returned empty or failed"
REASON_INVALID = "JSON/Pydantic validation failed: "
REASON_BYPASS = "Low-risk bypass (prob < 0.25 or no actionable flags)"
REASON_TEMPLATE = "Deterministic template (use_api=False, prob >= 0.25)"
ERROR_EMPTY = "Empty API response"
ERROR_FAILED = "API call failed"
NOTE_RESCUED = "Regex extraction after JSON parse failure"

# --- text spellings of a missing value in CSV files ---------------------------------------------
# The spellings common data-frame CSV readers take as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
