"""Counts, tokens and rates of audit records by event time, over a stream or a stored log.

A window is published once, when the newest record seen is ``late`` past its end; memory holds the open windows
alone.  A record that arrives after its window was published stays in the stored log and is counted by Spark as
dropped by the watermark; :func:`windowed_summary` over the stored log counts it, so a window can be corrected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.operators.audit import event_time, summary_columns

WIDTH, LATE = "1 hour", "10 minutes"


def windowed_summary(log: DataFrame, by: Sequence[str] = ("risk_tier",), width: str = WIDTH, late: str = LATE) -> DataFrame:
    """One row per window of ``width`` and group; a stored log gives all windows, a stream each one when it closes.

    Records whose timestamp is missing or no timestamp belong to no window.
    """
    timed = log.withColumn("_at", event_time()).withWatermark("_at", late)
    found = timed.groupBy(F.window("_at", width).alias("_window"), *by).agg(*summary_columns())
    start, end = F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")
    return found.select(start, end, *[c for c in found.columns if c != "_window"])


def closed_windows(log: DataFrame, by: Sequence[str] = ("risk_tier",), width: str = WIDTH, late: str = LATE) -> DataFrame:
    """The windows of a stored log that a stream over it has published by its end."""
    newest = log.agg((F.max(event_time()) - F.expr(f"INTERVAL {late}")).alias("_watermark"))
    found = windowed_summary(log, by, width, late)
    return found.join(newest, F.col("window_end") <= F.col("_watermark")).drop("_watermark")
