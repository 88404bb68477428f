"""Claims that several tests start from."""

CLAIM_COLUMNS = (
    "claim_id total_billed expected_payment num_procedures num_diagnoses days_to_submit prior_auth_required has_prior_auth "
    "is_in_network missing_documentation_flag eligibility_verified referral_required referral_present payer_type visit_type "
    "payer_id service_month"
).split()
THREE_CLAIMS = [
    ("C001", "10000", "8000", "3", "2", "5", "1", "0", "1", "0", "1", "0", "0", "Commercial", "Outpatient", "P001", "2024-06"),
    ("C002", "5000", "4000", "1", "1", "45", "0", "0", "1", "1", "1", "1", "0", "Medicare", "Inpatient", "P002", "2024-07"),
    ("C003", "2000", "1800", "2", "3", "15", "1", "1", "0", "0", "0", "1", "1", "Medicaid MCO", "Emergency", "P003", "2024-08"),
]
