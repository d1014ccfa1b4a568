"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables in ``sf_dir`` through the raw-table
adapters and runs over whole tables. Column names match the DuckDB oracle
statements in ``tidemart.oracle``.

Every call builds its models anew, so a query reads the files that are there
when it is called; within one query, models are built once and shared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.snapshot import latest
from tidemart.plans import checks, hourly, marts, operations, pipeline
from tidemart.plans.staging import STAGING_SPECS
from tidemart.plans.warehouse import Warehouse
from tidemart.session import apply_sql_conf, bound_task_input
from tidemart.sources.testdata import TestData

QueryFn = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, sf_dir: str, null_mode: str = "ansi") -> Warehouse:
    """A fresh model graph (callers may replace models with tables via ``use``)."""
    apply_sql_conf(spark)
    bound_task_input(spark)
    return Warehouse(TestData(spark, sf_dir).raw, null_mode=null_mode)


def _data(spark: SparkSession, sf_dir: str) -> TestData:
    apply_sql_conf(spark)
    bound_task_input(spark)
    return TestData(spark, sf_dir.rstrip("/"))


def _wh(spark: SparkSession, sf_dir: str, null_mode: str = "ansi") -> Warehouse:
    return warehouse(spark, sf_dir, null_mode)


def _stg(name: str) -> QueryFn:
    return lambda spark, d: _wh(spark, d).stg(name)


HOURLY_START = "1995-01-01 00:00:00"    # start of the inventory period: after the older stock count, before all movements


def q_dq_model_tests(spark, d):
    """The model tests, run on the tables that a build writes."""
    out = operations.scratch(spark, "model-tests")
    return pipeline.build_all(spark, _wh(spark, d), out, with_hourly=False).tests


def _wh_and_data(spark, d):
    td = _data(spark, d)
    return Warehouse(td.raw), td


def q_upsert_merge(spark, d):
    return operations.upsert_merge(*_wh_and_data(spark, d))


def q_get_or_create_ids(spark, d):
    return operations.get_or_create_category_ids(*_wh_and_data(spark, d))


def q_latest_version_dedupe(spark, d):
    return latest(_wh(spark, d).raw("raw_web_order_items"), ["id"], "loaded_at")


def q_dim_date(spark, d):
    wh = _wh(spark, d)
    bounds = wh.raw("raw_web_orders").agg(F.min(F.to_date("created_at")).alias("lo"),
                                          F.max(F.to_date("created_at")).alias("hi"))
    return Warehouse.dim_date_from_bounds(bounds)


def q_fact_order_items(spark, d):
    f = _wh(spark, d).fact_order_items
    return f.select(*[F.col(c).cast("double").alias(c) if c in ("revenue", "cogs", "gross_profit")
                      else F.col(c) for c in f.columns if c != "order_ts"])


def q_fact_sessions(spark, d):
    return _wh(spark, d).fact_sessions.drop("session_start")


def q_fact_fulfillment(spark, d):
    return _wh(spark, d).fact_fulfillment.drop("shipment_ts")


def _model(attr: str) -> QueryFn:
    return lambda spark, d: getattr(_wh(spark, d), attr)


def _mart(fn, **kw) -> QueryFn:
    return lambda spark, d: _wh(spark, d).model(fn, **kw)


QUERIES: dict[str, QueryFn] = {
    "latest_version_dedupe": q_latest_version_dedupe,
    **{name: _stg(name) for name in STAGING_SPECS},
    "dim_date": q_dim_date,
    "dim_customer": _model("dim_customer"),
    "dim_product": _model("dim_product"),
    "dim_campaign": _model("dim_campaign"),
    "dim_product_join_defaults": lambda spark, d: _wh(spark, d, null_mode="defaults").dim_product,
    "fact_fulfillment_join_defaults": lambda spark, d: _wh(spark, d, null_mode="defaults").fact_fulfillment.drop(
        "shipment_ts"),
    "fact_inventory_join_defaults": lambda spark, d: _wh(spark, d, null_mode="defaults").fact_inventory_snapshot,
    "fact_order_items": q_fact_order_items,
    "fact_sessions": q_fact_sessions,
    "fact_fulfillment": q_fact_fulfillment,
    "fact_inventory_snapshot": _model("fact_inventory_snapshot"),
    "fact_ad_stats": _model("fact_ad_stats"),
    "mart_sales": _mart(marts.mart_sales),
    "mart_marketing": _mart(marts.mart_marketing),
    "mart_marketing_last_touch": _mart(marts.mart_marketing, dedupe="last_touch"),
    "mart_marketing_all_channels": _mart(marts.mart_marketing, base="all"),
    "mart_inventory": _mart(marts.mart_inventory),
    "inventory_turns": _mart(marts.inventory_turns),
    "hourly_sales": _mart(hourly.hourly_sales),
    "hourly_marketing": _mart(hourly.hourly_marketing),
    "hourly_inventory": _mart(hourly.hourly_inventory, start=HOURLY_START),
    "dq_model_tests": q_dq_model_tests,
    "dq_ranges": _mart(checks.dq_ranges),
    "dq_orphans": _mart(checks.dq_orphans),
    "dq_unique_keys": _mart(checks.dq_unique_keys),
    "dq_invariants": _mart(checks.dq_invariants),
    "dq_rate_bands": _mart(checks.dq_rate_bands),
    "incremental_extract": _mart(operations.incremental_extract),
    "watermark_next": _mart(operations.watermark_next),
    "upsert_merge": q_upsert_merge,
    "get_or_create_ids": q_get_or_create_ids,
    "cost_backfill": _mart(operations.cost_backfill),
    "coerce_datetime_strings": lambda spark, d: operations.coerce_datetimes(_data(spark, d)),
    "orders_from_carts": _mart(operations.orders_from_carts),
    "latest_ids_topk": _mart(operations.latest_ids_topk),
    "partitioned_sink_roundtrip": lambda spark, d: operations.partitioned_sink_roundtrip(
        spark, _wh(spark, d), q_fact_order_items(spark, d)),
    "extract_load_cycle": lambda spark, d: operations.extract_load_cycle(spark, _wh(spark, d)),
    "versions_across_batches": lambda spark, d: operations.versions_across_batches(spark, _wh(spark, d)),
    "latest_state_three_loads": lambda spark, d: operations.latest_state_three_loads(spark, _wh(spark, d)),
    "upsert_in_place": lambda spark, d: operations.upsert_in_place(spark, *_wh_and_data(spark, d)),
    "watermark_cycle": lambda spark, d: operations.watermark_cycle(spark, _wh(spark, d)),
    "constrained_columns": _mart(operations.constrained_columns),
    "batch_layout_fallback": lambda spark, d: operations.batch_layout_fallback(spark, _wh(spark, d)),
    "stream_hourly_kpis": lambda spark, d: operations.stream_hourly_kpis(spark, _data(spark, d)),
    "stream_hourly_kpis_update": lambda spark, d: operations.stream_hourly_kpis_update(spark, _data(spark, d)),
    "stream_sessions": lambda spark, d: operations.stream_sessions(spark, _data(spark, d)),
    "stream_unique_events": lambda spark, d: operations.stream_unique_events(spark, _data(spark, d)),
    "stream_latest_orders": lambda spark, d: operations.stream_latest_orders(spark, _wh(spark, d)),
    "zoned_events": lambda spark, d: operations.zoned_events(_data(spark, d)),
    "raw_contracts": _mart(operations.raw_contracts),
    "visitors_by_period": lambda spark, d: operations.visitors_by_period(spark, _wh(spark, d)),
    "first_orders_by_load": lambda spark, d: operations.first_orders_by_load(spark, _wh(spark, d)),
    "stream_raw_load": lambda spark, d: operations.stream_raw_load(spark, _wh(spark, d)),
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)
