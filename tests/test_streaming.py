import os

from pyspark.sql import functions as F

from tidemart.streaming.hourly import replay_files, run_hourly_stream

SF = "/root/testdata/sf0.001"


def _batch(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    return {(r.w, r.event_type): (r.n, r.v) for r in e.groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v")).collect()}


def test_stream_complete_equals_batch(spark, tmp_dir):
    replay_files(spark.read.parquet(f"{SF}/events.parquet"), os.path.join(tmp_dir, "src"))
    out = run_hourly_stream(spark, os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "sink"),
                            os.path.join(tmp_dir, "ckpt"), ["event_type"], mode="complete",
                            max_files_per_trigger=4)
    got = {(r.window_start, r.event_type): (r.events, r.value_sum) for r in out.collect()}
    assert got == _batch(spark)


def test_stream_update_mode_versioned_sink(spark, tmp_dir):
    replay_files(spark.read.parquet(f"{SF}/events.parquet"), os.path.join(tmp_dir, "src"))
    out = run_hourly_stream(spark, os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "sink"),
                            os.path.join(tmp_dir, "ckpt"), ["event_type"], mode="update",
                            max_files_per_trigger=4)
    got = {(r.window_start, r.event_type): (r.events, r.value_sum) for r in out.collect()}
    assert got == _batch(spark)
