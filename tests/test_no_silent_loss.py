"""Ingest and sinks lose nothing without saying so."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemart.plans.warehouse import Warehouse
from tidemart.sources.batch_io import (UnreadableFiles, batch_path, read_batch, write_batch,
                                       write_partitioned_sorted)
from tidemart.sources.catalog import BY_NAME, RawTable
from tidemart.sources.ingest import Watermarks, extract_source, load_raw, naive_timestamps, read_raw

ORDERS = RawTable("raw_t", "web", "t", ("id",), "created_at", "id int, created_at timestamp_ntz, note string")


def day(n, h=12):
    return dt.datetime(2024, 6, n, h)


def truncate_one_file(root):
    files = [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    path = sorted(files)[0]
    data = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(data[:len(data) // 2])
    for d, _, fs in os.walk(root):       # object stores have no checksum files
        for f in fs:
            if f.endswith(".crc"):
                open(os.path.join(d, f), "wb").close()
                os.remove(os.path.join(d, f))
    return path


def test_truncated_file(spark, tmp_dir, caplog):
    df = spark.range(100).repartition(4)
    write_batch(df, tmp_dir, "web", "t", "2024-06-01", "a")
    truncate_one_file(tmp_dir)
    with pytest.raises(Exception):       # the day's own batch is damaged
        read_batch(spark, tmp_dir, "web", "t", "2024-06-01").collect()
    write_batch(df, tmp_dir, "web", "t", "2024-06-02", "b")
    assert read_batch(spark, tmp_dir, "web", "t", "2024-06-02").count() == 100      # another day's is not
    with pytest.raises(UnreadableFiles, match="1 unreadable"):
        read_batch(spark, tmp_dir, "web", "t", "2099-01-01")
    left = read_batch(spark, tmp_dir, "web", "t", "2099-01-01", skip_unreadable=True)
    assert 100 <= left.count() < 200 and caplog.text.count("skipped ") == 1


def test_two_extracts_of_one_day_before_a_load(spark, tmp_dir):
    marks = Watermarks(spark, f"{tmp_dir}/control")
    schema = "id int, created_at timestamp_ntz, note string"
    for rows in ([(1, day(1), "x"), (2, day(2), "x")], [(1, day(1), "x"), (2, day(2), "x"), (3, day(3), "x")]):
        source = spark.createDataFrame(rows, schema)
        extract_source(spark, "web", lambda t, s=source: s, f"{tmp_dir}/b", marks, "2024-01-01", [ORDERS],
                       run_date="2024-06-10")
    batch = read_batch(spark, f"{tmp_dir}/b", "web", "t", "2024-06-10")
    assert sorted(r.id for r in batch.collect()) == [1, 2, 2, 3]
    assert marks.get("web.t") == "2024-06-03"


def test_empty_batch_leaves_the_mark(spark, tmp_dir):
    marks = Watermarks(spark, f"{tmp_dir}/control")
    none = spark.createDataFrame([], "id int, created_at timestamp_ntz, note string")
    assert extract_source(spark, "web", lambda t: none, f"{tmp_dir}/b", marks, "2024-01-01", [ORDERS]) == {"raw_t": 0}
    assert marks.get("web.t", "2024-01-01") == "2024-01-01"


def test_month_that_vanishes_on_rebuild(spark, tmp_dir):
    rows = [(i, dt.date(2024, 1 + i % 3, 1)) for i in range(9)]
    df = spark.createDataFrame(rows, "id int, d date")
    path = f"{tmp_dir}/model"
    write_partitioned_sorted(df, path, "d", ["d", "id"])
    write_partitioned_sorted(df.where("month(d) <> 1"), path, "d", ["d", "id"])
    assert {r.yyyymm for r in spark.read.parquet(path).collect()} == {202402, 202403}
    write_partitioned_sorted(df.where("month(d) = 1"), path, "d", ["d", "id"], replace="periods")
    assert spark.read.parquet(path).count() == 9
    with pytest.raises(ValueError):
        write_partitioned_sorted(df, path, "d", ["d"], replace="some")


def test_batches_with_unlike_text_load_into_one_schema(spark, tmp_dir):
    path = f"{tmp_dir}/raw_t"
    for note, ts in (("2024", "2024-06-01 12:00:00"), ("DHL", " 2024-06-02 08:30:00 "), ("2024-01-01", "NaT")):
        df = spark.createDataFrame([(1, ts, note)], "id int, created_at string, note string")
        assert load_raw(df, path, ORDERS) == 1
    back = read_raw(spark, tmp_dir, ORDERS)
    assert dict(back.dtypes)["created_at"] == "timestamp_ntz" and dict(back.dtypes)["note"] == "string"
    assert sorted((r.note, r.created_at) for r in back.collect() if r.created_at) == [
        ("2024", day(1)), ("DHL", dt.datetime(2024, 6, 2, 8, 30))]
    assert back.count() == 3
    bad = spark.createDataFrame([(1, "soon", "x")], "id int, created_at string, note string")
    with pytest.raises(Exception):
        load_raw(bad, path, ORDERS)


def test_zoned_columns_are_stored_naive(spark, tmp_dir):
    df = spark.sql("SELECT 1 id, timestamp'2024-06-01 12:00:00+03:00' created_at, 'x' note")
    out = naive_timestamps(df)
    assert dict(out.dtypes)["created_at"] == "timestamp_ntz"
    assert out.first().created_at == day(1, 9)


def test_raw_table_without_rows_reads_empty(spark, tmp_dir):
    got = read_raw(spark, tmp_dir, BY_NAME["raw_web_orders"])
    assert got.count() == 0 and got.columns[-2:] == ["loaded_at", "load_seq"]


def test_models_build_on_empty_tables_and_without_hourly_ads(spark, tmp_dir):
    from tidemart.plans import hourly, marts
    wh = Warehouse(lambda name: read_raw(spark, tmp_dir, BY_NAME[name]))
    for fn in (marts.mart_sales, marts.mart_marketing, marts.mart_inventory, hourly.hourly_sales,
               hourly.hourly_marketing, hourly.hourly_inventory):
        assert fn(wh).count() == 0


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    from tidemart import session

    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Cluster()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_batch_layout(spark, tmp_dir):
    write_batch(spark.range(3), tmp_dir, "web", "t", "2024-06-01", "r1")
    assert os.path.isdir(batch_path(tmp_dir, "web", "t", "2024-06-01") + "/run=r1")


def test_take_any(spark):
    from tidemart.operators.merge import take_any
    assert take_any(spark.range(50).repartition(5), 7).count() == 7
    assert take_any(spark.range(3), 7).select(F.sum("id")).first()[0] == 3
