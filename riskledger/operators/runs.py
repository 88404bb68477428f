"""Experiment runs as a table: lifecycle rows, comparison and leaderboard."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_text = T.StringType()
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", _text),
    T.StructField("experiment_name", _text),
    T.StructField("timestamp", _text),
    T.StructField("status", _text),
    T.StructField("params", T.MapType(_text, _text)),
    T.StructField("metrics", T.MapType(_text, T.DoubleType())),
    T.StructField("tags", T.MapType(_text, _text)),
    T.StructField("artifact_uri", _text),
])

#: One step in the life of a run; maps and the address are null where the step does not tell them.
EVENT_SCHEMA = T.StructType([*RUN_SCHEMA.fields, T.StructField("at", T.LongType())])
STATES = ("RUNNING", "FINISHED", "FAILED")


def event(
    spark: SparkSession,
    experiment: str,
    run_id: str,
    timestamp: str,
    status: str,
    at: int,
    params: Mapping[str, Any] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    artifact_uri: str | None = None,
) -> DataFrame:
    """One event as a one-row frame; ``at`` orders the events of a run (a clock in microseconds)."""
    if status not in STATES:
        raise ValueError(f"status {status} is none of {', '.join(STATES)}")
    texts = [None if m is None else {k: str(v) for k, v in m.items()} for m in (params, tags)]
    numbers = None if metrics is None else {k: float(v) for k, v in metrics.items()}
    return spark.createDataFrame([(run_id, experiment, timestamp, status, texts[0], numbers, texts[1], artifact_uri, at)], EVENT_SCHEMA)


def current_state(events: DataFrame) -> DataFrame:
    """Run rows as their events left them: a run whose driver was lost stays RUNNING.

    A run starts anew with each RUNNING event, and what earlier attempts told is forgotten.  Within an attempt the last
    event gives the status (an end wins over a start at the same time), and every other field keeps its last known value.
    Events that were written twice count once.
    """
    run = ["experiment_name", "run_id"]
    order = F.struct("at", F.col("status") != "RUNNING")
    begun = F.max(F.when(F.col("status") == "RUNNING", F.col("at"))).over(Window.partitionBy(*run))
    attempt = events.withColumn("_begun", begun).filter(F.col("_begun").isNull() | (F.col("at") >= F.col("_begun")))
    known = {c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in ("params", "metrics", "tags", "artifact_uri")}
    state = attempt.groupBy(*run).agg(F.min("timestamp").alias("timestamp"), F.max_by("status", order).alias("status"), *known.values())
    empty = {"params": "map<string,string>", "metrics": "map<string,double>", "tags": "map<string,string>"}
    return state.select(*[
        F.coalesce(F.col(c), F.create_map().cast(empty[c])).alias(c) if c in empty else F.col(c) for c in RUN_SCHEMA.names
    ])


def run_row(
    spark: SparkSession,
    experiment: str,
    run_id: str,
    timestamp: str,
    status: str = "FINISHED",
    params: Mapping[str, Any] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    artifact_uri: str | None = None,
) -> DataFrame:
    """One run as a one-row frame; a failed run carries its error as a tag."""
    row = (
        run_id, experiment, timestamp, status,
        {k: str(v) for k, v in (params or {}).items()},
        {k: float(v) for k, v in (metrics or {}).items()},
        {k: str(v) for k, v in (tags or {}).items()},
        artifact_uri,
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def metrics_map(*names: str) -> Column:
    """Metric columns of an evaluation row as one map."""
    return F.create_map(*[part for n in names for part in (F.lit(n), F.col(n).cast("double"))])


def list_experiments(runs: DataFrame) -> DataFrame:
    return runs.select("experiment_name").distinct()


def list_runs(runs: DataFrame, experiment: str) -> DataFrame:
    """Runs of one experiment in run-id order; on a partitioned table only that folder is read."""
    return runs.filter(F.col("experiment_name") == experiment).orderBy("run_id")


def compare_runs(runs: DataFrame) -> DataFrame:
    """Long comparison: one row per experiment, metric and run."""
    return runs.select("experiment_name", "run_id", F.explode("metrics").alias("metric", "value"))


def run_matrix(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Wide comparison: one column per named metric."""
    return runs.select("experiment_name", "run_id", *[F.col("metrics")[m].alias(m) for m in metrics])


def best_per_metric(comparison: DataFrame, lower_is_better: tuple[str, ...] = ()) -> DataFrame:
    """The best run of every experiment and metric; the earliest run id wins ties.

    By default the largest value is best for every metric, also for losses; name those in
    ``lower_is_better`` to turn them round.
    """
    value = F.when(F.col("metric").isin(*lower_is_better), F.col("value")).otherwise(-F.col("value")) if lower_is_better else -F.col("value")
    first = F.struct(value, F.col("run_id"))
    return comparison.groupBy("experiment_name", "metric").agg(
        F.min_by("run_id", first).alias("run_id"), F.min_by("value", first).alias("value")
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of every experiment (largest run id)."""
    return runs.groupBy("experiment_name").agg(
        F.max("run_id").alias("run_id"), F.max_by("metrics", "run_id").alias("metrics")
    )


def leaderboard(runs: DataFrame) -> DataFrame:
    """Capture of the newest run of every experiment, best first, with the overall best marked."""
    capture = F.coalesce(
        F.col("metrics")["denial_capture_at_25"], F.col("metrics")["capture_at_25"], F.lit(0.0)
    )
    board = latest_runs(runs).select("experiment_name", "run_id", capture.alias("capture_at_25"))
    # One row per experiment: the best name is the first one to reach the highest positive capture.
    best = board.agg(
        F.min_by("experiment_name", F.struct(-F.col("capture_at_25"), F.col("experiment_name"))).alias("_best"),
        F.max("capture_at_25").alias("_top"),
    )
    return (
        board.crossJoin(F.broadcast(best))
        .withColumn("is_best", (F.col("experiment_name") == F.col("_best")) & (F.col("_top") > 0))
        .drop("_best", "_top")
        .orderBy(F.desc("capture_at_25"), "experiment_name")
    )
