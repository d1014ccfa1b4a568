"""Kept tables: latest rows and upserts by partition."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators.merge import upsert
from tidemart.operators.snapshot import latest
from tidemart.plans.warehouse import Warehouse
from tidemart.sources.catalog import BY_NAME, RawTable
from tidemart.sources.ingest import load_raw, read_raw
from tidemart.sources.keyed import KeyedTable, LatestState, NullKeys

T = RawTable("raw_t", "web", "t", ("id",), "created_at", "id int, created_at timestamp_ntz, note string")
DDL = "id int, v int, note string"


def files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def load(spark, root, ids, note):
    day = dt.datetime(2024, 6, 1)
    load_raw(spark.createDataFrame([(i, day, note) for i in ids], T.ddl).repartition(3), f"{root}/raw_t", T)


def test_state_equals_a_full_read_after_each_load(spark, tmp_dir):
    rnd = random.Random(1)
    for k in range(4):
        load(spark, tmp_dir, [rnd.randint(0, 60) for _ in range(rnd.choice([3, 80]))], f"load {k}")
        state = LatestState(spark, f"{tmp_dir}/state", T, parts=4, buckets=2)       # reopened each time
        raw = read_raw(spark, tmp_dir, T)
        state.refresh(raw)
        assert rows(state.read()) == rows(latest(raw, T.keys))
        assert rows(state.read(["note"])) == rows(latest(raw, T.keys, columns=["note"]).select("id", "note"))
    before = rows(state.read())
    state.refresh(raw)                                                              # repeated: nothing changes
    assert rows(state.read()) == before


def test_two_loads_between_refreshes_and_an_empty_raw_table(spark, tmp_dir):
    state = LatestState(spark, f"{tmp_dir}/state", T, parts=4, buckets=2)
    state.refresh(read_raw(spark, tmp_dir, T))
    assert state.read().count() == 0
    load(spark, tmp_dir, [1, 1, 2], "a")
    load(spark, tmp_dir, [2, 3], "b")
    state.refresh(read_raw(spark, tmp_dir, T))
    assert [(i, n) for i, _, n, *_ in rows(state.read())] == [(1, "a"), (2, "b"), (3, "b")]
    load(spark, tmp_dir, [1], "c")
    load(spark, tmp_dir, [4], "d")
    state.refresh(read_raw(spark, tmp_dir, T))
    assert [(i, n) for i, _, n, *_ in rows(state.read())] == [(1, "c"), (2, "b"), (3, "b"), (4, "d")]


def test_refresh_reads_only_the_newest_loads(spark, tmp_dir):
    load(spark, tmp_dir, range(50), "a")
    state = LatestState(spark, f"{tmp_dir}/state", T, parts=2, buckets=2)
    state.refresh(read_raw(spark, tmp_dir, T))
    load(spark, tmp_dir, [7], "b")
    since = state.since(read_raw(spark, tmp_dir, T))
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(loaded_at" in plan       # pushed to the scan: the footers of older loads rule them out
    assert since.count() == 51


def test_plan_of_a_merge_and_of_a_read(spark, tmp_dir):
    kept = KeyedTable(spark, f"{tmp_dir}/k", DDL, ["id"], parts=8, buckets=4)
    kept.merge(spark.createDataFrame([(i, i, "a") for i in range(200)], DDL), ["v"])
    batch = kept._with_part(spark.range(1, 2).select(F.col("id").cast("int"), F.lit(2).alias("v"), F.lit("b").alias("note")))
    plan = kept.combined(batch, lambda c, old, new: F.col(f"o.{c}"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "dynamicpruning" in plan.lower()
    assert plan.count("Exchange hashpartitioning(id") == 1       # the batch; the kept side is bucketed by the key
    read = kept.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in read and "Aggregate" not in read


def test_untouched_files_stay(spark, tmp_dir):
    kept = KeyedTable(spark, f"{tmp_dir}/k", DDL, ["id"], parts=8, buckets=2)
    kept.merge(spark.createDataFrame([(i, i, "a") for i in range(200)], DDL), ["v"])
    before = files(f"{tmp_dir}/k")
    kept.merge(spark.createDataFrame([(3, 99, "b")], DDL), ["v"])
    gone, new = before - files(f"{tmp_dir}/k"), files(f"{tmp_dir}/k") - before
    assert len({os.path.dirname(f) for f in gone | new}) == 1 and len(before) > 8
    assert kept.read().count() == 200 and kept.read().where("id = 3").first().v == 99
    kept.merge(spark.createDataFrame([(3, 5, "older"), (3, 7, "old")], DDL), ["v"])
    assert kept.read().where("id = 3").first().note == "b"


def test_upsert_is_that_of_the_whole_table(spark, tmp_dir):
    rnd = random.Random(5)
    target = spark.createDataFrame([(i, i, f"n{i}") for i in range(100)], DDL)
    kept = KeyedTable(spark, f"{tmp_dir}/k", DDL, ["id"], parts=4, buckets=2)
    kept.merge(target, ["v"])
    whole = target
    for k in range(3):
        up = spark.createDataFrame([(rnd.randint(50, 150), None if rnd.random() < 0.2 else rnd.randint(0, 9), f"u{k}", s)
                                    for s in range(40)], DDL + ", seq int")
        whole = spark.createDataFrame(upsert(whole, up, ["id"], ["v"], "seq").collect(), DDL)
        kept.upsert(up, ["v"], "seq")
        assert rows(kept.read()) == rows(whole)
    again = KeyedTable(spark, f"{tmp_dir}/k", DDL, ["id"], parts=4, buckets=2)
    assert rows(again.read()) == rows(whole)
    with pytest.raises(NullKeys):
        kept.merge(spark.createDataFrame([(None, 1, "x")], DDL), ["v"])


def test_models_read_the_state(spark, tmp_dir):
    t = BY_NAME["raw_web_users"]
    for k in range(2):
        load_raw(spark.createDataFrame([(i, f"{k}@x", None, None, None, "c", dt.datetime(2024, 1, 1)) for i in range(5 + k)], t.ddl),
                 f"{tmp_dir}/raw/{t.name}", t)
    state = LatestState(spark, f"{tmp_dir}/state", t)
    state.refresh(read_raw(spark, f"{tmp_dir}/raw", t))
    raw = lambda name: read_raw(spark, f"{tmp_dir}/raw", BY_NAME[name])     # noqa: E731
    kept = Warehouse(raw, state=lambda name: state.read())
    for get in (lambda w: w.stg("stg_web_users"), lambda w: w.stg("stg_web_users", ["id", "email"]),
                lambda w: w.final("raw_web_users", columns=["email"]).select("id", "email")):
        assert rows(get(kept)) == rows(get(Warehouse(raw)))
        assert "Exchange" not in get(kept)._jdf.queryExecution().executedPlan().toString()


def test_first_orders_after_each_load_also_with_late_orders(spark, tmp_dir):
    from tidemart.operators.running import running_min_members
    from tidemart.sources.keyed import FirstOrders
    rnd, schema = random.Random(3), "user_id long, order_ts timestamp_ntz, order_id long"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)      # noqa: E731
    # customer 0 has a third of all orders; ids do not follow the times
    orders = [(0 if rnd.random() < 0.33 else rnd.randint(1, 40), at(rnd.randint(0, 900)), i) for i in range(600)]
    rnd.shuffle(orders)
    kept, so_far = FirstOrders(spark, f"{tmp_dir}/f", parts=4, buckets=2), []
    for k in range(0, 600, 150):
        load_ = orders[k:k + 150]
        so_far += load_
        kept.add(spark.createDataFrame(load_ + load_[:5], schema))
        whole = running_min_members(spark.createDataFrame(so_far, schema), "user_id", "order_ts", "order_id")
        assert rows(kept.flagged()) == rows(whole)
    before = files(f"{tmp_dir}/f")
    kept.add(spark.createDataFrame([(7, at(-5), 10_000)], schema))      # older than all, but no smaller id: first, beside the others
    assert {os.path.dirname(f) for f in before - files(f"{tmp_dir}/f")} != {os.path.dirname(f) for f in before}
    want = {i for i, in rows(whole)} | {10_000}
    assert {i for i, in rows(kept.flagged())} == want


def test_sketches_unite(spark):
    from tidemart.plans import visitors
    days = spark.range(60_000).select((F.col("id") % 9000).alias("customer_sk"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("session_date"))

    class Wh:
        fact_sessions = days
    got = {(r.period, r.period_start): r.visitors for r in visitors.by_period(visitors.daily_sketches(Wh)).collect()}
    for r in visitors.exact(Wh).collect():
        assert abs(got[r.period, r.period_start] - r.exact_visitors) <= 0.03 * r.exact_visitors
