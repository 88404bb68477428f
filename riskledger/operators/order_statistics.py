"""Exact order statistics without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.workspace import stage_table

STEPS = 1000
_CARRIED = ("lo", "hi", "total", "below", "inside")


def percentile(df: DataFrame, value: str, share: float, by: Sequence[str] = (), out: str = "value", sort_at_most: int = 1 << 22) -> DataFrame:
    """The exact ``share`` percentile of ``value`` per group, interpolated between its two neighbours.

    The values alone are written, once.  While some group has more than ``sort_at_most`` rows inside its bracket, a
    quantile sketch of those rows names a bracket of some thousandths of them, and a count tells how many rows lie
    below and inside it; a bracket that misses the wanted place by that count is not taken.  At last the rows inside
    are added up per distinct value and only these are sorted.  All groups share the same jobs.

    Nulls are left out and NaN is the largest value.  A group without values has no row; without ``by`` there is
    always one row, null for no values.  Groups are few (models, not claims).
    """
    names = [f"_g{i}" for i in range(max(1, len(by)))]
    groups = [F.col(g) for g in by] or [F.lit(0)]
    # No filter before the table is written: it would be pushed below the projection and work the values out twice.
    narrow = df.select(*[g.alias(n) for g, n in zip(groups, names)], F.col(value).cast("double").alias("v"))
    rows = stage_table(narrow, "values").filter(F.col("v").isNotNull())
    brackets = stage_table(rows.groupBy(*names).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"),
        F.lit(0).cast("long").alias("below"), F.count("*").alias("inside"),
    ), "brackets")
    place = (F.col("total") - 1) * F.lit(float(share))
    widest = _widest(brackets)
    while widest > sort_at_most:
        brackets = stage_table(_narrowed(rows, brackets, names, place), "brackets")
        widest, before = _widest(brackets), widest
        if widest >= before:  # nothing gained: what is left is sorted as it is
            break

    per_value = _within(rows, brackets, names).groupBy(*names, "v", "total", "below").agg(F.count("*").alias("n"))
    upto = F.col("below") + F.sum("n").over(Window.partitionBy(*names).orderBy("v"))
    placed = per_value.withColumn("upto", upto)

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("n") <= index) & (index < F.col("upto")), F.col("v")))

    picked = placed.groupBy(*names).agg(
        at(F.floor(place)).alias("lower"), at(F.ceil(place)).alias("upper"), F.max(place - F.floor(place)).alias("part")
    )
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part")
    if not by:
        return picked.agg(F.max(between).alias(out))
    return picked.select(*[F.col(n).alias(g) for g, n in zip(by, names)], between.alias(out))


def _widest(brackets: DataFrame) -> int:
    """Most rows inside a bracket that still holds unlike values."""
    return brackets.agg(F.max(F.when(F.col("lo") < F.col("hi"), F.col("inside")))).first()[0] or 0


def _within(rows: DataFrame, brackets: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows inside the bracket of their group, with the bracket."""
    sides = brackets.select(*[F.col(n).alias(f"{n}_b") for n in names], *[c for c in brackets.columns if c not in names])
    match = F.col("v").between(F.col("lo"), F.col("hi"))
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"{n}_b"))
    return rows.join(sides, match).drop(*[f"{n}_b" for n in names])


def _narrowed(rows: DataFrame, brackets: DataFrame, names: Sequence[str], place: Column) -> DataFrame:
    """Brackets cut down to a few steps of the sketch's grid around the wanted place."""
    kept = [F.first(c).alias(c) for c in _CARRIED]
    grid = F.percentile_approx("v", [i / STEPS for i in range(STEPS + 1)], 10 * STEPS)
    step = (place - F.col("below")) / F.col("inside") * STEPS
    sketched = _within(rows, brackets, names).groupBy(*names).agg(grid.alias("grid"), *kept).select(
        *names, *_CARRIED,
        # Element i of the grid is the share (i - 1) / STEPS; two steps on either side exceed the error of the sketch.
        F.element_at("grid", F.greatest(F.lit(1), F.floor(step).cast("int") - 1)).alias("new_lo"),
        F.element_at("grid", F.least(F.lit(STEPS + 1), F.ceil(step).cast("int") + 3)).alias("new_hi"),
    )
    counted = _within(rows, stage_table(sketched, "sketches"), names).groupBy(*names).agg(
        *kept, F.first("new_lo").alias("new_lo"), F.first("new_hi").alias("new_hi"),
        F.count_if(F.col("v") < F.col("new_lo")).alias("under"),
        F.count_if(F.col("v").between(F.col("new_lo"), F.col("new_hi"))).alias("held"),
    )
    below = F.col("below") + F.col("under")
    holds = (below <= F.floor(place)) & (F.ceil(place) < below + F.col("held"))
    new = {"lo": F.col("new_lo"), "hi": F.col("new_hi"), "below": below, "inside": F.col("held")}
    return counted.select(*names, "total", *[F.when(holds, c).otherwise(F.col(n)).alias(n) for n, c in new.items()])
