"""Claim-risk analytics on Spark: contract, features, models, ranking, explanations, audit and runs."""

from riskledger.functions.features import add_features, model_inputs
from riskledger.functions.wording import friendly_label, ordered_label
from riskledger.operators.contract import check_inputs, check_outputs, validate_output
from riskledger.operators.explain import explain, prompt, request, request_violations, response_violations
from riskledger.operators.metrics import evaluate, score_summary
from riskledger.operators.ordering import global_rank
from riskledger.sources.claims import load_and_validate, read_raw, read_typed

__all__ = [
    "add_features", "check_inputs", "check_outputs", "evaluate", "explain", "friendly_label", "global_rank",
    "load_and_validate", "model_inputs", "ordered_label", "prompt", "read_raw", "read_typed", "request",
    "request_violations", "response_violations", "score_summary", "validate_output",
]
