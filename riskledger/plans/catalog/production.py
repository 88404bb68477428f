"""Query: the whole production run over all claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.plans.catalog.base import add
from riskledger.plans.catalog.texts import stub_writer
from riskledger.plans.production import produce
from riskledger.sources import stores
from riskledger.sources.orders import current_claims, history_claims
from riskledger.workspace import fresh_path


def production_run(spark, folder) -> DataFrame:
    """The stored list, audit, figures and state of a run at full size: what is exact about them, per tier."""
    root, run_id = fresh_path(spark, "production"), "20240101_000000_cccccc"
    done = produce(history_claims(spark, folder), current_claims(spark, folder), root, run_id, completion=stub_writer())
    stored = spark.read.parquet(f"{done['scored'].folder}/claims")
    log = stores.read_audit(spark, done["audit"].folder).select(K.KEY, "is_from_api", F.lit(1).alias("recorded"))
    document = spark.read.json(f"{done['metrics'].folder}/document")
    count = lambda c: F.count_if(c)
    tiers = stored.join(log, K.KEY, "left").groupBy("risk_tier").agg(
        F.count("*").alias("claims"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.count("recorded").alias("n_audited"),
        count(F.col("is_from_api") & (F.col("risk_tier") != "High")).alias("n_needless_calls"),
        count(F.coalesce(F.col("explanation"), F.lit("")) == "").alias("n_unexplained"),
        count(~F.col("denial_probability").between(0, 1)).alias("n_out_of_range"),
    )
    figures = document.select(
        F.lit(len(document.columns)).alias("metric_fields"),
        (F.col("test_roc_auc") > 0.75).alias("better_than_chance"),
        (F.col("brier_post_calibration") < F.col("brier_pre_calibration")).alias("calibration_helps"),
    )
    state = stores.read_states(spark, f"{root}/events").select("status")
    return tiers.crossJoin(F.broadcast(figures)).crossJoin(F.broadcast(state))  # one row each


add("production_run", production_run, """
SELECT risk_tier, count(*) AS claims, min(place) AS first_rank, max(place) AS last_rank, count(*) AS n_audited, 0 AS n_needless_calls,
  0 AS n_unexplained, 0 AS n_out_of_range, 13 AS metric_fields, true AS better_than_chance, true AS calibration_helps, 'FINISHED' AS status
FROM (SELECT place, CASE WHEN place <= floor(n * 0.25e0) THEN 'High' WHEN place <= 2 * floor(n * 0.25e0) THEN 'Medium' ELSE 'Low' END AS risk_tier
  FROM (SELECT row_number() OVER (ORDER BY claim_id) AS place, count(*) OVER () AS n FROM claims WHERE split = 'current') AS r) AS t
GROUP BY risk_tier""")
