import numpy as np
import pytest
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.operators import order_statistics as O
from riskledger.sources import stores


def frame(spark, groups):
    rows = [(g, None if v is None else float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("most", [50, 1 << 22])
@pytest.mark.parametrize("share", [0.0, 0.75, 0.999])
def test_percentiles_equal_numpy(spark, share, most):
    made = np.random.default_rng(5)
    groups = {
        "spread": made.normal(size=3001), "tied": np.repeat([0.2, 0.7, 0.9], [900, 2, 700]), "one": [4.0], "same": [2.5] * 400,
        None: made.integers(0, 9, 800), "gap": [0.0] * 3 + [1.0], "nulls": [None, 1.0, None, 3.0], "absent": [None],
    }
    got = {r.g: r.value for r in O.percentile(frame(spark, groups), "x", share, ["g"], sort_at_most=most).collect()}
    want = {g: np.percentile([v for v in values if v is not None], 100 * share) for g, values in groups.items() if g != "absent"}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], abs=1e-12) for g in want)


def test_percentile_without_groups(spark):
    rows = frame(spark, {"a": range(101), "b": []})
    assert O.percentile(rows, "x", 0.75, sort_at_most=7).first().value == 75.0
    assert O.percentile(rows.filter("x < 0"), "x", 0.75).collect()[0].value is None


def test_wrong_sketches_are_not_taken(spark, monkeypatch):
    monkeypatch.setattr(O.F, "percentile_approx", lambda column, shares, accuracy: F.array(*[F.lit(-1.0)] * len(shares)))
    assert O.percentile(frame(spark, {"a": range(101)}), "x", 0.75, sort_at_most=7).first().value == 75.0


def test_files_hold_one_range_of_ranks_each(spark, tmp_path):
    rows = spark.range(1, 96).select(F.col("id").alias("rank"), *[F.lit("x").alias(c) for c in K.SCORED_COLUMNS])
    path = str(tmp_path / "scored")
    stores.write_scored(rows.repartition(7), path, rows_per_file=10)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    files = stored.groupBy("file").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count("*").alias("n")).collect()
    assert sorted((f.a, f.b, f.n) for f in files) == [(a, min(a + 9, 95), min(10, 96 - a)) for a in range(1, 96, 10)]
