"""Staging models STG1-STG14.

Each staging model = latest version per identity key (SNAP1) -> projection
with default-filling coalesces -> second-resolution timestamps. One generic
operator, ``stage``, plus a declarative spec per model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import to_datetime
from tidemart.operators.snapshot import latest
from tidemart.sources.catalog import BY_NAME

c = F.col


def _coalesce(col: str, default) -> Column:
    return F.coalesce(c(col), F.lit(default)).alias(col)


def _dt(col: str, fallback: str | None = None) -> Column:
    src = F.coalesce(c(col), c(fallback)) if fallback else c(col)
    return to_datetime(src).alias(col)


# Staging model -> (raw table, projection).
STAGING_SPECS: dict[str, tuple[str, Callable[[], list[Column]]]] = {
    "stg_web_users": ("raw_web_users", lambda: [
        c("id"), c("email"), _coalesce("first_name", ""), _coalesce("last_name", ""),
        _coalesce("city", "Unknown"), c("country"), _dt("registered_at")]),
    "stg_web_products": ("raw_web_products", lambda: [
        c("id"), c("category_id"), c("name").alias("product_name"), c("price"),
        c("cost_price"), c("is_active"), _dt("created_at")]),
    "stg_web_categories": ("raw_web_categories", lambda: [
        c("id"), _coalesce("parent_id", 0), c("name")]),
    "stg_web_sessions": ("raw_web_sessions", lambda: [
        c("id"), _coalesce("user_id", 0), _coalesce("utm_source", ""),
        _coalesce("utm_campaign", ""), c("device_type"), _dt("started_at"),
        _dt("ended_at", "started_at"), c("page_views")]),
    "stg_web_carts": ("raw_web_carts", lambda: [
        c("id"), _coalesce("user_id", 0), c("session_id"), c("status"),
        _dt("created_at"), _dt("updated_at")]),
    "stg_web_orders": ("raw_web_orders", lambda: [
        c("id"), c("user_id"), _coalesce("cart_id", 0), c("total_amount"), c("status"),
        _dt("created_at")]),
    "stg_web_order_items": ("raw_web_order_items", lambda: [
        c("id"), c("order_id"), c("product_id"), c("quantity"), c("unit_price"),
        c("unit_cost"), _dt("created_at")]),
    "stg_oms_orders": ("raw_oms_orders", lambda: [
        c("id"), c("web_order_id"), c("status"), _dt("received_at"),
        _dt("confirmed_at", "received_at"), _dt("dispatched_at", "received_at"),
        _dt("created_at")]),
    "stg_oms_shipments": ("raw_oms_shipments", lambda: [
        c("id"), c("oms_order_id"), _coalesce("carrier_id", "Unknown"),
        F.coalesce(c("planned_delivery"), F.to_date("created_at")).alias("planned_delivery"),
        F.coalesce(c("actual_delivery"), F.to_date("created_at")).alias("actual_delivery"),
        _coalesce("is_on_time", 0), c("is_complete"), _dt("created_at")]),
    "stg_wms_inventory": ("raw_wms_inventory", lambda: [
        c("id"), c("wms_product_id"), c("quantity_on_hand"), c("quantity_reserved"),
        c("reorder_point"), _dt("updated_at")]),
    "stg_wms_inventory_movements": ("raw_wms_inventory_movements", lambda: [
        c("id"), c("wms_product_id"), c("movement_type"), c("quantity"), _dt("created_at")]),
    "stg_wms_picking_tasks": ("raw_wms_picking_tasks", lambda: [
        c("id"), c("oms_order_id"), c("wms_product_id"), c("quantity"), c("is_accurate"),
        c("is_substituted"), _dt("completed_at", "created_at")]),
    "stg_marketing_ad_stats": ("raw_marketing_ad_campaign_daily_stats", lambda: [
        c("id"), c("campaign_id"), F.to_date("stat_date").alias("stat_date"), c("impressions"),
        c("clicks"), c("spend"), c("conversions")]),
    "stg_marketing_visits": ("raw_marketing_visits", lambda: [
        c("id"), _coalesce("user_id", 0), _coalesce("source_id", 0),
        _coalesce("utm_campaign", ""), c("duration_sec"), c("page_views"), c("is_bounce"),
        _dt("visited_at")]),
}


# Raw columns a staged column needs beside or instead of its own.
STAGING_INPUTS: dict[str, dict[str, tuple[str, ...]]] = {
    "stg_web_products": {"product_name": ("name",)},
    "stg_web_sessions": {"ended_at": ("ended_at", "started_at")},
    "stg_oms_orders": {"confirmed_at": ("confirmed_at", "received_at"), "dispatched_at": ("dispatched_at", "received_at")},
    "stg_oms_shipments": {"planned_delivery": ("planned_delivery", "created_at"),
                          "actual_delivery": ("actual_delivery", "created_at")},
    "stg_wms_picking_tasks": {"completed_at": ("completed_at", "created_at")},
}


def stage(raw: DataFrame, name: str, columns: Sequence[str] | None = None, resolved: bool = False) -> DataFrame:
    """Latest version per identity key (unless ``raw`` is ``resolved``: has one row
    per key already), then the staging projection. Only the raw
    columns that ``columns`` of the model (default: all) need are read and moved."""
    raw_name, projection = STAGING_SPECS[name]
    keys = BY_NAME[raw_name].keys
    if columns is None:
        rows = raw if resolved else latest(raw, keys, columns=BY_NAME[raw_name].column_names)
        return rows.select(*projection())
    need = {i for c_ in columns for i in STAGING_INPUTS.get(name, {}).get(c_, (c_,))}
    staged = raw.limit(0).select(*projection()).columns
    picked = [p for p, n in zip(projection(), staged, strict=True) if n in columns]
    return (raw if resolved else latest(raw, keys, columns=sorted(need))).select(*picked)
