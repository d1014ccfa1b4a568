"""Versions follow the order of the batches; the tolerant fallback reads all that is sound."""
import logging
import os

import pytest
from pyspark.sql import functions as F

from tests.test_no_silent_loss import ORDERS, day, truncate_one_file
from tidemart.operators.snapshot import latest
from tidemart.sources.batch_io import UnreadableFiles, batch_path, probe_files, read_batch, write_batch
from tidemart.sources.ingest import load_batches, read_raw
from tidemart.streaming.ingest import read_latest, stream_load

SCHEMA = "id int, created_at timestamp_ntz, note string"


def batch(spark, ids, note, files=1):
    return (spark.range(ids).select(F.col("id").cast("int"), F.lit("2024-06-01 12:00:00").cast("timestamp_ntz").alias("created_at"),
                                    F.concat(F.lit(note), F.lit("x" * 20)).alias("note")).repartition(files))


# The scan reads the largest file first: the later batch is the larger or the smaller one.
@pytest.mark.parametrize("sizes", [(3, 200_000), (200_000, 3), (200_000, 200_000)])
@pytest.mark.parametrize("runs", [("2024-06-01", "a", "2024-06-01", "b"), ("2024-06-01", "z", "2024-06-02", "a"),
                                  ("2024-06-01", "009", "2024-06-01", "010")])
def test_the_later_batch_wins_in_one_load(spark, tmp_dir, sizes, runs):
    for k, note in enumerate(("old", "new")):
        write_batch(batch(spark, sizes[k], note), tmp_dir, "web", "t", runs[2 * k], runs[2 * k + 1])
    load_batches(spark, tmp_dir, f"{tmp_dir}/raw", ORDERS, "2099-01-01")
    got = latest(read_raw(spark, f"{tmp_dir}/raw", ORDERS), ["id"]).where("id < 3")
    assert {r.note[:3] for r in got.collect()} == {"new"} and got.count() == 3


def test_of_one_run_the_later_place_wins(spark, tmp_dir):
    rows = spark.createDataFrame([(1, day(1), f"v{k}") for k in range(50)], SCHEMA).coalesce(1)
    write_batch(rows, tmp_dir, "web", "t", "2024-06-01", "a")
    load_batches(spark, tmp_dir, f"{tmp_dir}/raw", ORDERS, "2024-06-01")
    assert latest(read_raw(spark, f"{tmp_dir}/raw", ORDERS), ["id"]).first().note == "v49"


def test_a_later_load_wins_over_a_later_day(spark, tmp_dir):
    write_batch(batch(spark, 3, "later day"), tmp_dir, "web", "t", "2024-06-02", "a")
    load_batches(spark, tmp_dir, f"{tmp_dir}/raw", ORDERS, "2024-06-02")
    write_batch(batch(spark, 3, "extracted again"), tmp_dir, "web", "t", "2024-06-01", "b")
    load_batches(spark, tmp_dir, f"{tmp_dir}/raw", ORDERS, "2024-06-01")
    assert {r.note[:9] for r in latest(read_raw(spark, f"{tmp_dir}/raw", ORDERS), ["id"]).collect()} == {"extracted"}


@pytest.mark.parametrize("sizes", [(3, 100_000), (100_000, 3)])
def test_stream_keeps_the_order_within_a_micro_batch(spark, tmp_dir, sizes):
    for size, run in zip(sizes, ("a", "b"), strict=True):
        write_batch(batch(spark, size, run), tmp_dir, "web", "t", "2024-06-01", run)
    stream_load(spark, batch_path(tmp_dir, "web", "t"), ORDERS, f"{tmp_dir}/raw_t", f"{tmp_dir}/ckpt", 1000)
    got = read_latest(spark, f"{tmp_dir}/raw_t", ["id"]).where("id < 3").collect()
    assert len(got) == 3 and {r.note[0] for r in got} == {"b"}


def only_file(root):
    files = [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    assert len(files) == 1
    return files[0]


def break_a_page(root):
    """Overwrites bytes in the middle of the data: the footer stays sound."""
    path = only_file(root)
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2:len(data) // 2 + 64] = b"\xff" * 64
    open(path, "wb").write(data)
    for f in os.listdir(os.path.dirname(path)):
        if f.endswith(".crc"):
            os.remove(os.path.join(os.path.dirname(path), f))
    return path


def test_sound_files_are_read_whole_and_damaged_ones_named(spark, tmp_dir, caplog):
    n = 50_000
    for run in ("cut", "broken", "sound", "empty"):
        df = spark.range(n if run != "empty" else 0).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("note")).coalesce(1)
        df.write.parquet(f"{batch_path(tmp_dir, 'web', 't', '2024-06-01')}/run={run}")
    at = batch_path(tmp_dir, "web", "t", "2024-06-01")
    cut, broken = truncate_one_file(f"{at}/run=cut"), break_a_page(f"{at}/run=broken")
    found = {os.path.basename(os.path.dirname(r.path)): (r.rows, r.fault) for r in
             probe_files(spark, batch_path(tmp_dir, "web", "t")).collect()}
    assert found["run=sound"] == (n, None) and found["run=empty"] == (0, None)
    assert found["run=cut"][1] and found["run=broken"][1]
    with pytest.raises(UnreadableFiles, match="2 unreadable"):
        read_batch(spark, tmp_dir, "web", "t", "2099-01-01")
    with caplog.at_level(logging.WARNING):
        left = read_batch(spark, tmp_dir, "web", "t", "2099-01-01", skip_unreadable=True)
    assert left.count() == n and {r.run for r in left.select("run").distinct().collect()} == {"sound"}
    assert left.agg(F.countDistinct("note")).first()[0] == n
    for path in (cut, broken):
        assert path in caplog.text


def test_a_sound_file_without_rows_is_no_fault(spark, tmp_dir):
    spark.range(0).coalesce(1).write.parquet(f"{batch_path(tmp_dir, 'web', 't', '2024-06-01')}/run=a")
    spark.range(5).coalesce(1).write.parquet(f"{batch_path(tmp_dir, 'web', 't', '2024-06-02')}/run=a")
    assert read_batch(spark, tmp_dir, "web", "t", "2099-01-01").count() == 5


def test_nothing_readable_is_an_error(spark, tmp_dir):
    spark.range(50).coalesce(1).write.parquet(f"{batch_path(tmp_dir, 'web', 't', '2024-06-01')}/run=a")
    truncate_one_file(tmp_dir)
    with pytest.raises(UnreadableFiles, match="none of the 1"):
        read_batch(spark, tmp_dir, "web", "t", "2099-01-01", skip_unreadable=True)
