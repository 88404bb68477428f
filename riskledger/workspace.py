"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskledger")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A single-machine session may leave the setting empty; it then gets a fresh folder of its own.
    On a cluster the setting is required: a machine-local folder would lose data with its executor.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="riskledger-")
    return _local_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpoints_on(spark: SparkSession) -> None:
    """Let iterative learners cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where several later steps must see the very same rows (for example positions in a sorted
    table): a lost executor then costs a re-read, never a second, possibly different, computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def compact(df: DataFrame, rows_per_task: int = 5_000, most_rows: int = 2_000_000) -> DataFrame:
    """A written table in one partition per core, fewer for few rows and more where a partition would get too large.

    Iterative learners run some thousand jobs over their rows; every task of every job costs a fixed share.  A task of a
    forest also hands on the sums of all open nodes, whatever its rows, so tasks beyond the cores only add to the shuffle.
    """
    rows, cores = df.count(), max(1, df.sparkSession.sparkContext.defaultParallelism)
    wanted = max(1, min(cores, -(-rows // rows_per_task)), -(-rows // most_rows))
    # Small files are read several to a partition, which can leave half the cores without rows.
    return df.coalesce(wanted) if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
