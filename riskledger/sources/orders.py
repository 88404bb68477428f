"""A claims table derived from an order-entry schema (orders, customer, lineitem)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger import constants as K

_CLAIM = """
    'CCLM-' || lpad(cast(o_orderkey as string), 8, '0') as claim_id
    case c_mktsegment when 'AUTOMOBILE' then 'BCBS' when 'FURNITURE' then 'Medicaid MCO'
         when 'HOUSEHOLD' then 'Medicare Advantage' else 'Commercial' end as payer_type
    case o_orderpriority when '1-URGENT' then 'Emergency' when '2-HIGH' then 'Inpatient'
         when '3-MEDIUM' then 'Observation' else 'Outpatient' end as visit_type
    'P' || lpad(cast(c_nationkey % 12 + 1 as string), 3, '0') as payer_id
    o_totalprice as total_billed
    o_totalprice * (0.4e0 + (o_custkey % 50) * 0.01e0) as expected_payment
    coalesce(n_lines, 1) as num_procedures
    1 + o_custkey % 8 as num_diagnoses
    (o_orderkey * 7 + o_custkey) % 101 as days_to_submit
    case when o_orderkey % 2 = 0 then 1 else 0 end as prior_auth_required
    case when o_orderkey % 3 <> 0 then 1 else 0 end as has_prior_auth
    case when o_custkey % 5 <> 0 then 1 else 0 end as is_in_network
    case when o_orderkey % 7 = 0 then 1 else 0 end as missing_documentation_flag
    case when o_custkey % 11 <> 0 then 1 else 0 end as eligibility_verified
    case when o_orderkey % 4 = 1 then 1 else 0 end as referral_required
    case when o_custkey % 3 <> 0 then 1 else 0 end as referral_present
    date_format(o_orderdate, 'yyyy-MM') as service_month
    case when o_orderstatus = 'P' then 'current' when o_orderkey % 10 < 6 then 'train'
         when o_orderkey % 10 < 8 then 'validation' else 'test' end as split
"""

_DENIED = """
    case when split = 'current' then null
         when 3 * auth_gap + 3 * missing_documentation_flag + 2 * ref_gap
              + case when days_to_submit > 30 then 1 else 0 end
              + (1 - eligibility_verified) + (1 - is_in_network)
              + (o_orderkey * 13 + o_custkey * 5) % 9 >= 9 then 1 else 0 end
"""

_REASON = """
    case when is_denied is null or is_denied = 0 then null
         when auth_gap = 1 then 'authorization' when missing_documentation_flag = 1 then 'documentation'
         when ref_gap = 1 then 'referral' when days_to_submit > 30 then 'timely filing'
         when eligibility_verified = 0 then 'eligibility' when is_in_network = 0 then 'network'
         else 'other' end
"""


def _items(block: str) -> list[str]:
    """One expression per ``as name`` ending."""
    out, pending = [], ""
    for line in block.strip().splitlines():
        pending += " " + line.strip()
        if " as " in line and not line.rstrip().endswith("then"):
            out.append(pending.strip())
            pending = ""
    return out


def claims_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One claim per order: 17 raw columns, split, label and reason.

    Line items are counted per order before the join, so the join carries one row per order.  The
    customer side is left to the optimizer, which broadcasts it only under the size threshold.
    """
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customer = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", "c_mktsegment", "c_nationkey"
    )
    lines = (
        spark.read.parquet(f"{folder}/lineitem.parquet")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n_lines"))
    )
    base = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, "o_orderkey", "left")
    gaps = {
        "auth_gap": F.expr("case when prior_auth_required = 1 and has_prior_auth = 0 then 1 else 0 end"),
        "ref_gap": F.expr("case when referral_required = 1 and referral_present = 0 then 1 else 0 end"),
    }
    return (
        base.selectExpr("o_orderkey", "o_custkey", *_items(_CLAIM))
        .withColumns(gaps)
        .withColumn(K.TARGET, F.expr(_DENIED))
        .withColumn(K.REASON, F.expr(_REASON))
        .select(*K.RAW_COLUMNS, *K.HISTORY_ONLY)
    )


def history_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled claims."""
    return claims_from_orders(spark, folder).filter(F.col(K.SPLIT) != "current")


def current_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Unlabelled claims, without the history-only columns."""
    claims = claims_from_orders(spark, folder).filter(F.col(K.SPLIT) == "current")
    return claims.drop(*K.HISTORY_ONLY)
