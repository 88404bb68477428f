"""Mixing sources to target weights: whole copies of documents, drawn by a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.llm.shared import WORD, Scratch, small_side

#: Weights of the sources by code point, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is repeated more often than this.
MOST_COPIES = 3.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the row's id and text alone."""
    seed = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size and target of every source of ``sizes`` (source, source_size); one row per source.

    All targets add up to all sizes.  A source's share is its weight's share, but ``most`` times its
    size at most; what is cut off is shared again by weight.  Sharing again and again ends where every
    source has the smaller of its bound and one common level times its weight.  The level is found at once
    by taking sources in the order in which they meet their bounds.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    bound = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("bound", F.col("source_size") * most)
    order = Window.orderBy(F.col("bound") / F.col("weight"), "place")
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(Window.partitionBy()) - before) / F.sum("weight").over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    free = bound.withColumn("level", level)
    reached = F.when(F.col("level") <= F.col("bound") / F.col("weight"), F.col("level"))
    common = F.max(reached).over(Window.partitionBy())
    target = F.least(F.col("bound"), common * F.col("weight"))
    return free.select("source", "source_size", target.alias("target"))


def copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (size, draw, source and others) with source_size, target and copies.

    A source is repeated target / source_size times: every document as often as the whole part says, and
    once more if its draw is below the fraction.  Sources without words have no copies.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = scratch.stage(targets(sizes).withColumnRenamed("source", "_source"), "targets", keep=True)
    joined = rows.join(small_side(per_source), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    return joined.withColumn("copies", whole + F.when(F.col("draw") < rate - whole, 1).otherwise(0))


def mix_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (doc_id, text, source).

    Null texts have no words and take part with size 0; a null source is a source of its own.  Rows with
    equal id and text share their draw.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        rows = docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("draw")
        )
        mixed = copies(rows, scratch)
        return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    with Scratch(docs.sparkSession, "mix") as scratch:
        rows = docs.select(
            F.struct("*").alias("row"),
            F.col("source").alias("source"),
            word_count(F.col("text")).alias("size"),
            draw(F.col("doc_id"), F.col("text")).alias("draw"),
        )
        mixed = copies(rows, scratch).filter("copies > 0")
        return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496 AS draw
  FROM {docs}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
bounds AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    source_size * 3.0::DOUBLE AS bound FROM sources),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM bounds) - coalesce(sum(bound) OVER (ORDER BY bound / weight, place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY bound / weight, place
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM bounds),
targets AS (
  SELECT source, source_size, least(bound, weight * (SELECT max(level) FROM levels WHERE level <= bound / weight)) AS target FROM levels),
rates AS (
  SELECT d.doc_id, d.size, d.draw, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rates
"""
