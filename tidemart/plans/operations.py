"""Registered queries for the ingest, merge, back-fill, sink and streaming
operators. Every query reads the driver's tables through the adapters and
processes whole tables; queries that exercise a sink write under the shared
folder named by spark.checkpoint.dir and return what they read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.coerce import coerce_datetime_strings
from tidemart.functions.kpi import MONEY
from tidemart.operators.merge import add_column, backfill_cost, get_or_create_ids, upsert
from tidemart.operators.quality import schema_contract
from tidemart.operators.snapshot import latest
from tidemart.plans import visitors
from tidemart.plans.warehouse import Warehouse
from tidemart.session import checkpoint_dir
from tidemart.sources.batch_io import (batch_path, read_batch, write_batch,
                                       write_partitioned_sorted)
from tidemart.sources.catalog import BY_NAME, RAW_TABLES
from tidemart.sources.ingest import (Watermarks, extract_incremental, extract_source, load_batches, load_raw, naive_timestamps, next_watermark,
                                     read_raw)
from tidemart.sources.keyed import FirstOrders, KeyedTable, LatestState
from tidemart.sources.testdata import TestData
from tidemart.streaming.events import run_sessions, run_unique, stream_latest
from tidemart.streaming.hourly import order_files, replay_files, run_hourly_stream

c = F.col
TOPK = 100
# Watermarks of the registered queries: older than all rows of the test tables,
# and one that keeps part of the orders.
BEFORE_ALL = "1900-01-01"
AMID = "1998-06-15"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemart/{name}-{uuid.uuid4().hex[:12]}"


def incremental_extract(wh: Warehouse) -> DataFrame:
    """SRC2 with a watermark amid the data: web orders newer than it."""
    return extract_incremental(wh.raw("raw_web_orders"), "created_at", AMID)


def watermark_next(wh: Warehouse) -> DataFrame:
    """AGG11/AGG12/F21 over the whole catalogue: the watermark each table
    would advance to after one run from a watermark older than the data."""
    parts = []
    for t in RAW_TABLES:
        batch = extract_incremental(wh.raw(t.name), t.ts_col, BEFORE_ALL)
        parts.append(next_watermark(batch, t.ts_col, BEFORE_ALL)
                     .select(F.lit(f"{t.source}.{t.table}").alias("table_name"), "max_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


USER_COLS = ["id", "email", "first_name", "last_name", "city", "country", "registered_at"]


def user_updates(td: TestData) -> DataFrame:
    """An update batch for the users table: customers in debt moved (new
    e-mail and city, unknown city below -500) plus every supplier as a new user.
    Each moved customer comes twice, first with an address that does not hold;
    ``seq`` is the order in which the rows were sent."""
    cu = td.table("customer", ["c_custkey", "c_name", "c_acctbal"]).where(c("c_acctbal") < 0)
    moved = cu.select(
        c("c_custkey").alias("id"),
        F.concat(F.lit("moved"), c("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        c("c_name").alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.when(c("c_acctbal") < -500, F.lit(None)).otherwise(F.lit("Relocated")).alias("city"),
        F.lit("Unknown").alias("country"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("registered_at"), F.lit(2).alias("seq"))
    passing = moved.withColumns({"email": F.lit("zz-on-the-way@example.com"), "city": F.lit("Transit"),
                                 "seq": F.lit(1)})
    su = td.table("supplier", ["s_suppkey", "s_name"])
    new = su.select(
        (c("s_suppkey") + 1000000).alias("id"),
        F.concat(F.lit("supplier"), c("s_suppkey").cast("string"), F.lit("@example.com")).alias("email"),
        c("s_name").alias("first_name"), F.lit("Supplier").alias("last_name"),
        F.lit("Unknown").alias("city"), F.lit("Unknown").alias("country"),
        F.lit("2024-06-01 00:00:00").cast("timestamp_ntz").alias("registered_at"), F.lit(1).alias("seq"))
    return moved.unionByName(passing).unionByName(new)


def upsert_merge(wh: Warehouse, td: TestData) -> DataFrame:
    """MERGE1: users upserted with the batch; only email and city update."""
    target = wh.final("raw_web_users", columns=USER_COLS).select(*USER_COLS)
    return upsert(target, user_updates(td), ["id"], ["email", "city"], "seq")


def get_or_create_category_ids(wh: Warehouse, td: TestData) -> DataFrame:
    """MERGE2: part types as category names; unknown names get new ids, and a second
    call on the grown table finds them."""
    values = td.table("part", ["p_partkey", "p_type"])
    cats = wh.final("raw_web_categories", columns=["name"]).select("id", "name")
    first = get_or_create_ids(values, "p_type", cats, "name", "id")
    again = get_or_create_ids(values, "p_type", cats.unionByName(first.created), "name", "id")
    return (first.values.select("p_partkey", "p_type", c("id").alias("category_id"))
            .join(again.values.select("p_partkey", c("id").alias("category_id_again")), "p_partkey"))


def cost_backfill(wh: Warehouse) -> DataFrame:
    """DML1 over every cart item."""
    items = wh.final("raw_web_cart_items").drop("loaded_at")
    return backfill_cost(items, wh.final("raw_web_products"))


def datetime_text(td: TestData) -> DataFrame:
    """A batch whose timestamps arrived as text (blanks included)."""
    e = td.table("events", ["event_id", "ts", "event_type"])
    eid = c("event_id")
    txt = c("ts").cast("string")
    return e.select(
        "event_id",
        F.when(eid % 11 == 0, F.lit("")).when(eid % 13 == 0, F.lit("NaT")).otherwise(txt).alias("ts_text"),
        "event_type",
        F.when(eid % 17 == 0, F.lit("not a date")).otherwise(txt).alias("mixed_text"),
        F.to_date("ts").cast("string").alias("day_text"))


def coerce_datetimes(td: TestData) -> DataFrame:
    """F19 on the text batch."""
    return coerce_datetime_strings(datetime_text(td))


def orders_from_carts(wh: Warehouse) -> DataFrame:
    """AGG13 + DQ8: per converted cart, items total vs. total of its orders."""
    carts = wh.stg("stg_web_carts").where(c("status") == "converted").select(
        c("id").alias("cart_id"), "user_id")
    items = wh.final("raw_web_cart_items").groupBy("cart_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum((c("quantity") * c("price_at_time")).cast(MONEY)).alias("items_d"))
    orders = wh.stg("stg_web_orders").where(c("cart_id") != 0).groupBy("cart_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(c("total_amount").cast(MONEY)).alias("orders_d"))
    j = carts.join(items, "cart_id", "left").join(orders, "cart_id", "left")
    it = F.coalesce(c("items_d"), F.lit(0).cast(MONEY))
    ot = F.coalesce(c("orders_d"), F.lit(0).cast(MONEY))
    return j.select("cart_id", "user_id",
                    F.coalesce(c("n_items"), F.lit(0)).alias("n_items"),
                    it.cast("double").alias("items_total"),
                    F.coalesce(c("n_orders"), F.lit(0)).alias("n_orders"),
                    ot.cast("double").alias("order_total"),
                    (F.abs(it - ot) <= F.lit(0.01)).alias("reconciled"))


def latest_ids_topk(wh: Warehouse, n: int = TOPK) -> DataFrame:
    """TOPK1: the n highest order ids (a top-k report; the limit is the feature)."""
    o = wh.stg("stg_web_orders").select("id", "user_id", "status", "created_at")
    return o.orderBy(c("id").desc()).limit(n)


def partitioned_sink_roundtrip(spark: SparkSession, wh: Warehouse, fact: DataFrame) -> DataFrame:
    """SRC11 + SORT1: write the sales fact partitioned by toYYYYMM(order_date)
    and sorted by its order key, then read it back."""
    path = scratch(spark, "fact_order_items")
    write_partitioned_sorted(fact, path, "order_date", ["order_date", "customer_sk", "product_sk"])
    return spark.read.parquet(path)


def batch_layout_fallback(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SRC4-SRC7: all web orders written as two batches of one day (two runs), then
    a load of a day that has no batch, which falls back to every batch."""
    base = scratch(spark, "extract")
    orders = wh.raw("raw_web_orders")
    newer = extract_incremental(orders, "created_at", AMID)
    write_batch(orders.join(newer.select("id").distinct(), "id", "left_anti"), base, "web", "orders", "2024-06-01", "a")
    write_batch(newer, base, "web", "orders", "2024-06-01", "b")
    assert batch_path(base, "web", "orders", "2024-06-01").endswith("ds=2024-06-01")
    loaded = read_batch(spark, base, "web", "orders", "2099-01-01")
    return loaded.withColumn("ds", c("ds").cast("string"))


CYCLE_TABLES = ["raw_web_orders", "raw_web_users", "raw_marketing_ad_campaign_daily_stats"]


def _cycle(spark: SparkSession, wh: Warehouse):
    """Two extract and load cycles over CYCLE_TABLES: the first day extracts twice
    before it loads (the second run re-reads the newest day), the next day
    extracts again and loads."""
    root = scratch(spark, "cycle")
    marks = Watermarks(spark, f"{root}/control")
    tables = [BY_NAME[n] for n in CYCLE_TABLES]

    def extract(ds, run):
        extract_source(spark, "all", lambda t: wh.raw(t.name).select(*t.column_names), f"{root}/batches", marks,
                       BEFORE_ALL, tables, run_date=ds, run=run)

    def load(ds):
        for t in tables:
            load_batches(spark, f"{root}/batches", f"{root}/raw", t, ds)
    extract("2024-06-01", "a")
    extract("2024-06-01", "b")
    load("2024-06-01")
    extract("2024-06-02", "c")
    load("2024-06-02")
    return root, marks


def extract_load_cycle(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SRC3, SRC5, SRC8, SRC9, INC1-INC3, MERGE3 over all of orders: every order at its
    latest version, and how many copies the raw table holds of it."""
    root, _ = _cycle(spark, wh)
    t = BY_NAME["raw_web_orders"]
    raw = read_raw(spark, f"{root}/raw", t)
    copies = raw.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    return latest(raw, t.keys).drop("loaded_at").join(copies, "id")


# Batches of versions_across_batches: day, run, every n-th order, status. In "shrinking"
# a later batch is smaller, in "growing" larger.
VERSION_BATCHES = {
    "shrinking": [("2024-06-01", "a", 1, "pending"), ("2024-06-01", "b", 3, "paid"), ("2024-06-02", "a", 5, "shipped")],
    "growing": [("2024-06-01", "a", 5, "pending"), ("2024-06-01", "b", 3, "paid"), ("2024-06-02", "a", 1, "shipped")]}


def versions_across_batches(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SRC9, INC3, SNAP1: orders change status between two runs of a day and between
    two days. Loaded day by day, by one fallback load of all batches and by a
    stream, the latest batch wins whatever its size; ``copies`` are the versions held."""
    from tidemart.streaming.ingest import read_latest, stream_load
    t = BY_NAME["raw_web_orders"]
    orders = wh.raw(t.name).select(*t.column_names)
    out = []
    for order, batches in VERSION_BATCHES.items():
        root = scratch(spark, "versions")
        for ds, run, every, status in batches:
            write_batch(orders.where(c("id") % every == 0).withColumn("status", F.lit(status)),
                        f"{root}/batches", t.source, t.table, ds, run)
        for ds in sorted({b[0] for b in batches}):
            load_batches(spark, f"{root}/batches", f"{root}/by_day", t, ds)
        load_batches(spark, f"{root}/batches", f"{root}/fallback", t, "2099-01-01")
        stream_load(spark, batch_path(f"{root}/batches", t.source, t.table), t, f"{root}/stream/{t.name}",
                    f"{root}/checkpoint", max_files_per_trigger=1_000_000)
        for way in ("by_day", "fallback", "stream"):
            if way == "stream":
                raw, now = spark.read.parquet(f"{root}/stream/{t.name}"), read_latest(spark, f"{root}/stream/{t.name}", t.keys)
            else:
                raw = read_raw(spark, f"{root}/{way}", t)
                now = latest(raw, t.keys, columns=t.column_names)
            out.append(now.join(raw.groupBy("id").agg(F.count(F.lit(1)).alias("copies")), "id")
                       .select(F.lit(order).alias("batches"), F.lit(way).alias("way"), "id", "status", "copies"))
    return reduce(DataFrame.unionByName, out)


def latest_state_three_loads(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SNAP1/WIN3 kept: three loads of orders, each merged into the kept latest rows
    alone; what is read is the table, not the history."""
    t = BY_NAME["raw_web_orders"]
    orders = wh.raw(t.name).select(*t.column_names)
    out = []
    for order, batches in VERSION_BATCHES.items():
        root = scratch(spark, "state")
        for k, (_, _, every, status) in enumerate(batches):
            load_raw(orders.where(c("id") % every == 0).withColumn("status", F.lit(status)), f"{root}/raw/{t.name}", t)
            state = LatestState(spark, f"{root}/state", t)      # another handle each time: what counts is on disk
            state.refresh(read_raw(spark, f"{root}/raw", t))
        out.append(state.read().select(F.lit(order).alias("batches"), *t.column_names))
    return reduce(DataFrame.unionByName, out)


def upsert_in_place(spark: SparkSession, wh: Warehouse, td: TestData) -> DataFrame:
    """MERGE1 on a kept table: users, then the update batch into the partitions it touches."""
    ddl = ", ".join(f"{n} {kind}" for n, kind in BY_NAME["raw_web_users"].columns if n in USER_COLS)
    kept = KeyedTable(spark, scratch(spark, "users"), ddl, ["id"])
    kept.merge(wh.final("raw_web_users", columns=USER_COLS).select(*USER_COLS), ["registered_at"])
    kept.upsert(user_updates(td), ["email", "city"], "seq")
    return kept.read()


def watermark_cycle(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """INC1/INC2: the control table after the cycles."""
    _, marks = _cycle(spark, wh)
    return marks.table().select("table_name", F.date_format("max_date", "yyyy-MM-dd").alias("max_date"))


def constrained_columns(wh: Warehouse) -> DataFrame:
    """DML2: cart items with a margin column that must be there and at most the price."""
    items = wh.final("raw_web_cart_items").select("id", "price_at_time", "cost_price")
    margin = F.greatest(c("price_at_time") - F.coalesce(c("cost_price"), F.lit(0.0)), F.lit(0.0))
    return add_column(items, "margin", margin, not_null=True, check="margin <= price_at_time")


def stream_hourly_kpis(spark: SparkSession, td: TestData) -> DataFrame:
    """INC4 + INC5: replay events as a file stream; hourly windows per event
    type, complete output mode."""
    root = scratch(spark, "stream")
    replay_files(td.table("events"), f"{root}/source")
    return run_hourly_stream(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint",
                             ["event_type"], mode="complete")


def stream_raw_load(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SRC8/SRC9/INC3 as a stream: all web orders laid out as daily batches, loaded
    by a file stream into the raw table, read back with the latest-version
    rule."""
    from tidemart.streaming.ingest import read_latest, stream_load
    root = scratch(spark, "stream_load")
    t = BY_NAME["raw_web_orders"]
    (wh.raw(t.name).select(*t.column_names)
     .withColumns({"ds": F.date_format("created_at", "yyyy-MM"), "run": F.lit("a")})
     .repartition("ds").write.partitionBy("ds", "run").parquet(batch_path(root, t.source, t.table)))
    stream_load(spark, batch_path(root, t.source, t.table), t, f"{root}/{t.name}", f"{root}/checkpoint")
    return read_latest(spark, f"{root}/{t.name}", ["id"])


def stream_hourly_kpis_update(spark: SparkSession, td: TestData) -> DataFrame:
    """INC4 with bounded state: update mode, windows freed behind the watermark, readers
    take the latest value of each window."""
    root = scratch(spark, "stream")
    replay_files(td.table("events"), f"{root}/source")
    order_files(spark, f"{root}/source")
    return run_hourly_stream(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint",
                             ["event_type"], mode="update")


def stream_sessions(spark: SparkSession, td: TestData) -> DataFrame:
    """§2.12: sessions of all events by user, 30 minutes apart, from a replayed stream."""
    root = scratch(spark, "sessions")
    replay_files(td.table("events"), f"{root}/source")
    order_files(spark, f"{root}/source")
    run = run_sessions(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", close=True)
    return run.sessions.withColumn("late_events", F.lit(run.late).cast("long"))


def overlapping_batches(events: DataFrame, path: str) -> None:
    """Every day's events twice: with their own day and again with the next, as an
    extract with a day's mark reads the newest day again."""
    day = F.to_date("ts")
    twice = events.withColumn("day", F.explode(F.array(day, F.date_add(day, 1))))
    twice.hint("rebalance", "day").sortWithinPartitions("day", "ts").write.mode("overwrite").partitionBy("day").parquet(path)
    order_files(events.sparkSession, path)


def stream_unique_events(spark: SparkSession, td: TestData) -> DataFrame:
    """§2.12: overlapping batches of events, each event once."""
    root = scratch(spark, "unique")
    overlapping_batches(td.table("events"), f"{root}/source")
    out, _ = run_unique(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", ["event_id"])
    return out


def stream_latest_orders(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """SNAP1 as a stream: the batches of VERSION_BATCHES merged into the kept latest orders."""
    t = BY_NAME["raw_web_orders"]
    orders = wh.raw(t.name).select(*t.column_names)
    out = []
    for order, batches in VERSION_BATCHES.items():
        root = scratch(spark, "stream-state")
        for ds, run, every, status in batches:
            write_batch(orders.where(c("id") % every == 0).withColumn("status", F.lit(status)),
                        f"{root}/batches", t.source, t.table, ds, run)
        state = LatestState(spark, f"{root}/state", t)
        rows = stream_latest(spark, batch_path(f"{root}/batches", t.source, t.table), state, f"{root}/checkpoint", 1_000_000)
        out.append(rows.select(F.lit(order).alias("batches"), *t.column_names))
    return reduce(DataFrame.unionByName, out)


def zoned_events(td: TestData) -> DataFrame:
    """F20 over all events: times that arrive with a zone three hours ahead are stored as their UTC wall clock."""
    e = td.table("events", ["event_id", "ts", "event_type"])
    zoned = e.withColumn("ts", F.to_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+03:00"))))
    return naive_timestamps(zoned)


def raw_contracts(wh: Warehouse) -> DataFrame:
    """DQ10 over every raw table: per column its contract, what is there, and its rows and nulls."""
    parts = []
    for t in RAW_TABLES:
        raw = wh.raw(t.name).drop("loaded_at", "load_seq")
        found = schema_contract(raw, t.schema, t.name)
        there = [r for r in found if r[3] is not None]
        counts = raw.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(r[1])).alias(f"c{k}") for k, r in enumerate(there)])
        rows = F.explode(F.array(*[F.struct(
            F.lit(name).alias("column_name"), F.lit(exp).alias("expected"), F.lit(act).alias("actual"), F.lit(status).alias("status"),
            c("n").alias("n_rows"), (c("n") - (c(f"c{there.index(r)}") if r in there else F.lit(0))).alias("n_nulls"))
            for r in found for _, name, exp, act, status in [r]]))
        parts.append(counts.select(F.lit(t.name).alias("table_name"), rows.alias("r")).select("table_name", "r.*"))
    return reduce(DataFrame.unionByName, parts)


def visitors_by_period(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """AGG3/AGG4: daily sketches are stored; days, weeks and months come from the stored
    table, beside the exact counts; the estimate is within 3 % of them."""
    path = scratch(spark, "visitors")
    visitors.daily_sketches(wh).write.parquet(path)
    out = visitors.by_period(spark.read.parquet(path)).join(visitors.exact(wh), ["period", "period_start"])
    return out.select("period", "period_start", "sessions", "exact_visitors",
                      (F.abs(c("visitors") - c("exact_visitors")) <= 0.03 * c("exact_visitors")).alias("estimate_holds"))


def first_orders_by_load(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """WIN1 kept: all web orders in three loads, each with orders older than those before
    it; every order with its flag."""
    orders = wh.stg("stg_web_orders").select("user_id", c("created_at").alias("order_ts"), c("id").alias("order_id"))
    kept = FirstOrders(spark, scratch(spark, "first-orders"))
    for k in (1, 0, 2):
        kept.add(orders.where(F.pmod(c("order_id"), F.lit(3)) == k))
    return (orders.join(kept.flagged().withColumn("is_first_order", F.lit(1)), "order_id", "left")
            .select("order_id", "user_id", F.coalesce(c("is_first_order"), F.lit(0)).alias("is_first_order")))
