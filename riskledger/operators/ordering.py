"""Global order without a single-task sort.

``row_number() over (order by ...)`` with no partition key moves every row into one task.  The
helpers here give the same answers from a range-partitioned sort (all key columns take part, so rows
that tie on the score are spread by their id) or from score ranges that are balanced by quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.workspace import partition_count, stage_table

_POSITION_BITS = 33


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    within: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """``df`` with the 1-based position of each row in the total order ``order``.

    ``order`` should end in a unique column.  With ``within``, positions restart per group, and a
    group may be of any size; the number of groups must be small (models, not claims).  ``total``
    names a column for the number of rows in the group.

    The rows are sorted over range partitions and written once; a row's position inside its sorted
    partition plus the sizes of the partitions before it is its rank.  Only the partition sizes (one
    row per sort partition and group) are broadcast.
    """
    keys = [F.col(g) for g in within]
    slot, part = "_slot", "_part"
    ordered = df.orderBy(*keys, *order).withColumn(slot, F.monotonically_increasing_id())
    staged = stage_table(ordered, "ranked")
    staged = staged.withColumn(part, F.shiftright(slot, _POSITION_BITS))

    # One row per (sort partition, group): bounded by the shuffle partition count plus the groups.
    sizes = staged.groupBy(part, *within).agg(F.count("*").alias("_n"), F.min(slot).alias("_first"))
    earlier = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*within)
    offsets = sizes.select(
        F.col(part).alias("_p"),
        *[F.col(g).alias(f"_w{i}") for i, g in enumerate(within)],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(whole).alias("_total"),
    )
    match = F.col(part) == F.col("_p")
    for i, g in enumerate(within):
        match = match & F.col(g).eqNullSafe(F.col(f"_w{i}"))
    placed = staged.join(F.broadcast(offsets), match)
    columns = [F.col(c) for c in df.columns]
    columns.append((F.col(slot) + F.col("_shift")).alias(rank))
    if total:
        columns.append(F.col("_total").alias(total))
    return placed.select(*columns)


def score_splits(df: DataFrame, score: str, buckets: int | None = None) -> list[float]:
    """Bucket edges that spread the rows of ``df`` evenly over score ranges.

    One pass over the score column alone, with mergeable sketches.  A score that many rows share
    yields repeated quantiles, which collapse into one edge.
    """
    buckets = buckets or partition_count(df.sparkSession)
    edges: list[float] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        edges = sorted(set(df.approxQuantile(score, shares, 1.0 / (4 * buckets))))
    return [float("-inf"), *edges, float("inf")]


def with_bucket(df: DataFrame, score: str, splits: list[float], bucket: str) -> DataFrame:
    """Adds the index of the score range of each row (binary search in the JVM)."""
    if len(splits) <= 2:
        return df.withColumn(bucket, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=score, outputCol=bucket).transform(df)


def order_breaks(df: DataFrame, rank: str, value: str, rows_per_bucket: int = 1 << 20) -> DataFrame:
    """One row, ``breaks``: how often ``value`` rises from one rank to the next.

    Ranks are cut into fixed-width buckets that are checked side by side; the bucket edges (one row
    per ``rows_per_bucket`` ranks) are then compared with each other.
    """
    bucket = F.floor((F.col(rank) - 1) / rows_per_bucket)
    inside = Window.partitionBy("_b").orderBy(rank)
    stepped = df.select(bucket.alias("_b"), F.col(rank), F.col(value)).withColumn(
        "_prev", F.lag(value).over(inside)
    )
    edges = stepped.groupBy("_b").agg(
        F.count_if(F.col(value) > F.col("_prev")).alias("_breaks"),
        F.min_by(value, rank).alias("_head"),
        F.max_by(value, rank).alias("_tail"),
    )
    across = edges.withColumn("_before", F.lag("_tail").over(Window.orderBy("_b")))
    joints = F.when(F.col("_head") > F.col("_before"), 1).otherwise(0)
    return across.agg(F.coalesce(F.sum(F.col("_breaks") + joints), F.lit(0)).alias("breaks"))
