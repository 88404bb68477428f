"""Named queries over the driver tables, each with its expected SQL where SQL can state it."""

from riskledger.plans.catalog import inputs, models, production, scores, texts  # noqa: F401 - they register queries
from riskledger.plans.catalog.base import QUERIES, expected_results

__all__ = ["QUERIES", "expected_results"]
