"""A frozen scorecard: scoring, ranking and attribution with known coefficients.

Fitted once by the logistic learner on training claims and rounded.  It gives every step after the
fit an exact expected result and serves as a ready-to-use baseline.
"""

from riskledger.operators.ensembles import Sigmoid
from riskledger.operators.scoring import Scorecard

# Weight per category level; (mean, spread, weight) per number.
LEVELS = {
    "payer_type": {
        "BCBS": -0.01511, "Commercial": 0.001958, "Medicaid MCO": 0.01646, "Medicare Advantage": -0.003462,
    },
    "visit_type": {"Emergency": -0.02121, "Inpatient": 0.0128, "Observation": 0.02185, "Outpatient": -0.0116},
    "payer_id": {
        "P001": -0.01763, "P002": 0.006312, "P003": -0.03896, "P004": -0.05062, "P005": 0.0183, "P006": -0.01727,
        "P007": -0.002936, "P008": -0.005554, "P009": 0.07443, "P010": 0.01833, "P011": 0.02844, "P012": -0.006679,
    },
}
NUMBERS = {
    "total_billed": (249400.0, 144300.0, 0.0005102),
    "expected_payment": (160800.0, 102000.0, -0.003647),
    "num_procedures": (4.012, 1.969, -0.001538),
    "num_diagnoses": (4.482, 2.295, 0.01173),
    "days_to_submit": (50.08, 29.14, 0.002936),
    "prior_auth_required": (0.4985, 0.5, 0.01043),
    "has_prior_auth": (0.6675, 0.4711, -0.07291),
    "is_in_network": (0.8012, 0.3991, -0.04611),
    "missing_documentation_flag": (0.1423, 0.3493, 0.242),
    "eligibility_verified": (0.9084, 0.2885, -0.01763),
    "referral_required": (0.2496, 0.4328, 0.003708),
    "referral_present": (0.6675, 0.4711, -0.05362),
    "service_month_num": (6.33, 3.417, 0.0484),
    "service_quarter": (2.447, 1.11, -0.04794),
    "auth_gap": (0.1656, 0.3717, 0.5036),
    "referral_gap": (0.081, 0.2728, 0.2068),
    "doc_issue": (0.1423, 0.3493, 0.242),
    "elig_issue": (0.0916, 0.2885, 0.01763),
    "network_issue": (0.1988, 0.3991, 0.04611),
    "late_filing": (0.6949, 0.4605, 0.5),
    "payment_ratio": (0.6448, 0.1443, 0.05607),
    "payment_gap": (88650.0, 66050.0, 0.006738),
    "log_total_billed": (12.13, 0.9657, 0.2276),
    "log_expected_payment": (11.66, 0.9921, -0.2288),
    "billed_per_procedure": (85820.0, 85240.0, -0.02281),
    "billed_per_diagnosis": (85210.0, 93600.0, -0.004368),
    "complexity_score": (17.98, 13.53, 0.006872),
    "total_admin_gaps": (0.6793, 0.7425, 0.4858),
    "oon_auth_gap": (0.03349, 0.1799, -0.07145),
    "oon_referral_gap": (0.01628, 0.1265, -0.0346),
    "double_deficit": (0.02368, 0.1521, -0.09046),
    "is_high_risk_combo": (0.0792, 0.27, -0.02117),
    "submission_delay": (3.865, 1.233, -0.02267),
}
INTERCEPT = -0.3157
CALIBRATION = Sigmoid(slope=0.98, offset=-1.21)

SCORECARD = Scorecard(INTERCEPT, LEVELS, NUMBERS, CALIBRATION)
