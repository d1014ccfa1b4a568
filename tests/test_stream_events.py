"""Streams with bounded state: sessions, unique events, kept latest rows."""
import datetime as dt
import os

from pyspark.sql import functions as F

from tidemart.plans.operations import overlapping_batches
from tidemart.sources.batch_io import batch_path, write_batch
from tidemart.sources.catalog import RawTable
from tidemart.sources.keyed import LatestState
from tidemart.streaming.events import run_sessions, run_unique, stream_latest
from tidemart.streaming.hourly import EVENTS_SCHEMA, order_files

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def event(i, minutes, user=1, value=1.0):
    return (i, T0 + dt.timedelta(minutes=minutes), user, "view", value, None)


def put(spark, path, day, rows):
    spark.createDataFrame(rows, EVENTS_SCHEMA).coalesce(1).write.parquet(f"{path}/day=2024-01-{int(day) + 1:02d}")


def sessions(run):
    return sorted((r.user_id, (r.session_start - T0).total_seconds() / 60, (r.session_end - T0).total_seconds() / 60, r.events)
                  for r in run.sessions.collect())


def test_sessions_merge_across_micro_batches(spark, tmp_dir):
    put(spark, f"{tmp_dir}/src", "1", [event(1, 0), event(2, 20), event(3, 0, user=2)])
    put(spark, f"{tmp_dir}/src", "2", [event(4, 45), event(5, 74), event(6, 105)])     # 29 and 31 minutes apart
    put(spark, f"{tmp_dir}/src", "3", [event(7, 135), event(8, 166), event(9, 5000)])   # 30 minutes after: the same session; 31: a new one
    order_files(spark, f"{tmp_dir}/src")
    run = run_sessions(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files=1, close=True)
    assert sessions(run) == [(1, 0, 104, 4), (1, 105, 165, 2), (1, 166, 196, 1), (1, 5000, 5030, 1), (2, 0, 30, 1)]
    assert run.late == 0


def test_late_events_are_counted_and_state_is_freed(spark, tmp_dir):
    for day in range(6):
        put(spark, f"{tmp_dir}/src", str(day), [event(day * 100 + k, day * 1440 + k, user=k) for k in range(50)])
    put(spark, f"{tmp_dir}/src", "6", [event(900, 3), event(901, 4), event(902, 6 * 1440)])     # two of six days ago
    order_files(spark, f"{tmp_dir}/src")
    run = run_sessions(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files=1, close=True)
    assert run.late == 2 and run.sessions.count() == 301
    assert max(run.state) <= 101        # two days' sessions at most, of six


def test_running_job_leaves_the_last_sessions_open(spark, tmp_dir):
    put(spark, f"{tmp_dir}/src", "1", [event(1, 0)])
    put(spark, f"{tmp_dir}/src", "2", [event(2, 500)])
    order_files(spark, f"{tmp_dir}/src")
    run = run_sessions(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files=1)
    assert run.late is None and len(sessions(run)) <= 1
    put(spark, f"{tmp_dir}/src", "3", [event(3, 510)])                                  # resumed: the open session goes on
    run = run_sessions(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files=1, close=True)
    assert sessions(run) == [(1, 0, 30, 1), (1, 500, 540, 2)]


def test_overlapping_batches_give_each_event_once_with_bounded_state(spark, tmp_dir):
    events = spark.read.parquet(f"{SF}/events.parquet")
    overlapping_batches(events, f"{tmp_dir}/src")
    out, state = run_unique(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", ["event_id"])
    total, days = events.count(), events.select(F.to_date("ts")).distinct().count()
    assert spark.read.parquet(f"{tmp_dir}/src").count() == 2 * total
    assert sorted(map(tuple, out.select("event_id", "ts").collect())) == sorted(map(tuple, events.select("event_id", "ts").collect()))
    assert days == 30 and max(state) < total / 3        # about six days of keys at two files a batch


T = RawTable("raw_t", "web", "t", ("id",), "created_at", "id int, created_at timestamp_ntz, note string")


def test_stream_latest_resumes(spark, tmp_dir):
    state = LatestState(spark, f"{tmp_dir}/state", T, parts=2, buckets=2)

    def send(run, ids):
        write_batch(spark.createDataFrame([(i, T0, run) for i in ids], T.ddl), f"{tmp_dir}/b", "web", "t", "2024-06-01", run)
    send("a", range(10))
    send("b", [1, 2])
    root = batch_path(f"{tmp_dir}/b", "web", "t")
    stream_latest(spark, root, state, f"{tmp_dir}/ckpt")
    send("c", [2, 50])
    got = {r.id: r.note for r in stream_latest(spark, root, state, f"{tmp_dir}/ckpt").collect()}
    assert got == {i: "a" for i in range(10)} | {1: "b", 2: "c", 50: "c"}
    assert os.path.isdir(f"{tmp_dir}/state/raw_t")
