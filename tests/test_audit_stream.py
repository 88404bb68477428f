from pyspark.sql import functions as F

from riskledger.operators.audit import RECORD_SCHEMA
from riskledger.streaming.audit import closed_windows, windowed_summary
from riskledger.streaming.review import store_stream


def log(spark, minutes, tier="High"):
    """Records made at the given minutes of a day, with ten tokens each."""
    rows = spark.createDataFrame([(m,) for m in minutes], "m long")
    made = {
        "timestamp": F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + 60 * F.col("m")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
        "risk_tier": F.lit(tier), "is_from_api": F.col("m") % 2 == 0, "total_tokens": F.lit(10).cast("long"),
        "has_disclaimer": F.lit(True), "total_duration_ms": F.col("m"),
    }
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])


def arrive(spark, tmp_path, records):
    """The records are one file that the stream reads by itself; a stream goes on where the last one ended."""
    records.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = windowed_summary(spark.readStream.schema(RECORD_SCHEMA).parquet(f"{tmp_path}/in"))
    query = store_stream(stream, f"{tmp_path}/out", f"{tmp_path}/progress")
    query.awaitTermination(120)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out"), dropped


def test_stream_equals_batch_and_late_records_are_counted(spark, tmp_path):
    first, second = log(spark, [5, 20, 59, 61, 62]), log(spark, [55, 64, 130, 131], "High").union(log(spark, [90], "Low"))
    got, dropped = arrive(spark, tmp_path, first)
    # Minute 62 leaves the first hour open: ten minutes of delay are allowed.
    assert got.count() == 0 and dropped == 0
    got, dropped = arrive(spark, tmp_path, second)
    stored = spark.read.schema(RECORD_SCHEMA).parquet(f"{tmp_path}/in")
    assert got.exceptAll(closed_windows(stored)).count() == closed_windows(stored).exceptAll(got).count() == 0
    assert [(r.risk_tier, r.total_calls, r.api_calls, r.total_tokens) for r in got.orderBy("window_start", "risk_tier").collect()] == [
        ("High", 4, 1, 40), ("High", 3, 2, 30), ("Low", 1, 1, 10)]
    assert dropped == 0
    # A record of the first hour after it was published: not in the stream's result, but in that of the stored log.
    late, dropped = arrive(spark, tmp_path, log(spark, [30]))
    assert dropped == 1 and late.exceptAll(got).count() == 0
    hours = windowed_summary(spark.read.schema(RECORD_SCHEMA).parquet(f"{tmp_path}/in")).orderBy("window_start", "risk_tier").collect()
    assert [r.total_calls for r in hours] == [5, 3, 1, 2]


def test_records_without_a_time_belong_to_no_window(spark):
    rows = log(spark, [5, 6]).withColumn("timestamp", F.when(F.col("is_from_api"), F.lit("no time")))
    assert windowed_summary(rows).count() == 0 and windowed_summary(rows.limit(0)).count() == 0
    assert closed_windows(rows).count() == 0
