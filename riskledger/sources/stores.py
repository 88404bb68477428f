"""Tables and files the engine writes and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger import constants as K
from riskledger.operators.audit import RECORD_SCHEMA, run_summary
from riskledger.operators.runs import EVENT_SCHEMA, RUN_SCHEMA, current_state
from riskledger.workspace import partition_count

AUDIT_FILE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("total_calls", T.LongType()),
    T.StructField("api_calls", T.LongType()),
    T.StructField("fallbacks", T.LongType()),
    T.StructField("token_summary", T.StructType([
        T.StructField("total_prompt_tokens", T.LongType()),
        T.StructField("total_completion_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
    ])),
    T.StructField("quality_summary", T.StructType([
        T.StructField("total_calls", T.LongType()),
        T.StructField("api_success_rate", T.DoubleType()),
        T.StructField("json_parse_rate", T.DoubleType()),
        T.StructField("pydantic_pass_rate", T.DoubleType()),
        T.StructField("disclaimer_rate", T.DoubleType()),
        T.StructField("avg_latency_ms", T.DoubleType()),
    ])),
    T.StructField("records", T.ArrayType(RECORD_SCHEMA)),
])


# --- scored table and metrics -------------------------------------------------------------------

def write_scored(scored: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists", rows_per_file: int = 1 << 20) -> None:
    """The six published columns, preceded by the rank, as files sorted by rank.

    Ranks are taken to run from 1 without gaps.  The block ``floor((rank - 1) / rows_per_file)`` names the task, so
    nothing is sampled and the rows are worked out once.  A task with several blocks sorts them, and its files are cut
    at ``rows_per_file`` rows, so that each file holds one block.  Rows without a rank are sorted over range partitions.
    """
    if "rank" in scored.columns:
        block = F.floor((F.col("rank") - 1) / rows_per_file)
        tasks = partition_count(scored.sparkSession)
        laid = scored.select("rank", *K.SCORED_COLUMNS).repartitionById(tasks, F.pmod(block, F.lit(tasks)).cast("int")).sortWithinPartitions("rank")
    else:
        laid = scored.select(*K.SCORED_COLUMNS).orderBy(F.desc("denial_probability"), K.KEY)
    laid.write.mode(mode).option("header", True).option("maxRecordsPerFile", rows_per_file).format(file_format).save(path)


def write_metrics(document: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row metrics frame as JSON."""
    document.write.mode(mode).json(path)


# --- experiment runs ----------------------------------------------------------------------------

def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").partitionBy("experiment_name").parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Events are only ever added: a reader sees a run from its first event on."""
    events.write.mode("append").partitionBy("experiment_name").parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The runs of a table of events, each in its latest state."""
    schema = T.StructType([*[f for f in EVENT_SCHEMA.fields if f.name != "experiment_name"], EVENT_SCHEMA["experiment_name"]])
    return current_state(spark.read.schema(schema).parquet(path))


def append_predictions(predictions: DataFrame, path: str) -> None:
    """(experiment_name, run_id, claim_id, prob), partitioned so that one run is one folder."""
    predictions.write.mode("append").partitionBy("experiment_name", "run_id").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*[f for f in RUN_SCHEMA.fields if f.name != "experiment_name"], RUN_SCHEMA["experiment_name"]])
    return spark.read.schema(schema).parquet(path).select(*RUN_SCHEMA.names)


def write_run_document(run: DataFrame, folder: str, experiment: str, run_id: str) -> None:
    """A one-row run as ``<folder>/<experiment>/<run>/run_metadata.json``; a rerun replaces it."""
    run.coalesce(1).write.mode("overwrite").json(f"{folder}/{experiment}/{run_id}/run_metadata.json")


def read_run_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Run documents kept one per folder, ``<folder>/<experiment>/<run>/run_metadata.json`` (a file, or a folder of one)."""
    raw = spark.read.schema(RUN_SCHEMA).option("multiLine", True).json(f"{folder}/*/*/run_metadata.json")
    named = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+/run_metadata\.json(?:/[^/]*)?$", 1)
    return raw.withColumn("experiment_name", F.coalesce(F.col("experiment_name"), named))


# --- audit logs ---------------------------------------------------------------------------------

def write_audit(log: DataFrame, path: str, run_id: str) -> None:
    """Records stored under their run, next to a one-row summary of the run; a rerun replaces both.

    Records stay rows: a run of any size is never gathered into one document.
    """
    tagged = log.withColumn("run_id", F.lit(run_id))
    _replace_run(tagged, f"{path}/records")
    # The summary is taken from what was written, so it always describes the stored records.
    stored = read_audit(log.sparkSession, path).filter(F.col("run_id") == run_id)
    _replace_run(run_summary(stored), f"{path}/headers")


def _replace_run(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).parquet(f"{path}/records")


def read_audit_files(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Nested audit documents as rows; older documents without summaries give nulls there."""
    documents = spark.read.schema(AUDIT_FILE_SCHEMA).option("multiLine", one_per_file).json(path)
    return documents.select("*", F.explode_outer("records").alias("record")).drop("records")
