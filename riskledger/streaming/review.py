"""Scoring and template explanations for claims that arrive as a stream.

Features, scores, factors and template texts look at one claim only, so the batch functions are used
unchanged; nothing is kept between micro-batches.  Ranks and tiers need all claims of a period and
stay a batch step over the stored scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskledger import constants as K
from riskledger.operators.attribution import factor_text
from riskledger.operators.explain import plain_text, request, template_response
from riskledger.operators.scoring import Scorecard, predicted, risk_label
from riskledger.plans.review import score_with_card


def explained_stream(claims: DataFrame, card: Scorecard, threshold: float) -> DataFrame:
    """Score, label, factors and text per arriving claim."""
    scored = score_with_card(claims, card)
    prob = F.col("denial_probability")
    text = plain_text(template_response(request(F.col(K.KEY), prob, F.col("factors"))))
    return scored.select(
        K.KEY,
        "denial_probability",
        predicted(prob, F.lit(float(threshold))).alias("predicted_denial"),
        risk_label(prob).alias("risk_label"),
        factor_text(F.col("factors")).alias("top_risk_factors"),
        text.alias("explanation"),
    )


def store_stream(explained: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to a file sink, exactly once per input file set."""
    return (
        explained.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
