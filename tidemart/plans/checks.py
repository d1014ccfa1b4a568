"""Check suites over the warehouse.

Each suite is a fixed, declarative spec evaluated with
``tidemart.operators.quality.run_checks``; the oracle builds its SQL from the
same specs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.quality import (accepted_values, band, expect, not_null, orphans,
                                        run_checks, unique)
from tidemart.plans.warehouse import Warehouse
from tidemart.sources.catalog import (CART_STATUSES, CHANNEL_TYPES, MOVEMENT_TYPES,
                                      OMS_ORDER_STATUSES, ORDER_STATUSES, PAGE_EVENT_TYPES,
                                      RETURN_STATUSES)

# The model tests of the reference (model, column, test, accepted values).
MODEL_TESTS = [
    ("stg_web_users", "id", "not_null", None),
    ("stg_web_users", "id", "unique", None),
    ("stg_web_users", "email", "not_null", None),
    ("stg_web_users", "country", "not_null", None),
    ("stg_web_products", "id", "not_null", None),
    ("stg_web_products", "id", "unique", None),
    ("stg_web_products", "price", "not_null", None),
    ("stg_web_products", "cost_price", "not_null", None),
    ("stg_web_orders", "id", "not_null", None),
    ("stg_web_orders", "id", "unique", None),
    ("stg_web_orders", "user_id", "not_null", None),
    ("stg_web_orders", "status", "accepted_values",
     ["pending", "paid", "processing", "shipped", "delivered", "cancelled", "refunded"]),
    ("stg_web_carts", "id", "not_null", None),
    ("stg_web_carts", "status", "not_null", None),
    ("stg_web_carts", "status", "accepted_values", ["active", "abandoned", "converted"]),
    ("stg_oms_orders", "id", "not_null", None),
    ("stg_oms_orders", "id", "unique", None),
    ("stg_oms_orders", "status", "accepted_values",
     ["received", "confirmed", "dispatched", "delivered", "cancelled"]),
    ("stg_wms_inventory", "id", "not_null", None),
    ("stg_wms_inventory", "wms_product_id", "not_null", None),
    ("stg_marketing_visits", "id", "not_null", None),
    ("dim_date", "date_sk", "not_null", None),
    ("dim_date", "date_sk", "unique", None),
    ("dim_date", "date_day", "not_null", None),
    ("dim_date", "year", "not_null", None),
    ("dim_date", "month", "not_null", None),
    ("dim_date", "month", "accepted_values", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]),
    ("dim_date", "day_of_week", "accepted_values", [1, 2, 3, 4, 5, 6, 7]),
    ("dim_date", "is_weekend", "accepted_values", [0, 1]),
    ("dim_customer", "customer_sk", "not_null", None),
    ("dim_customer", "customer_sk", "unique", None),
    ("dim_customer", "email", "not_null", None),
    ("dim_product", "product_sk", "not_null", None),
    ("dim_product", "product_sk", "unique", None),
    ("dim_product", "product_name", "not_null", None),
    ("dim_product", "price", "not_null", None),
    ("dim_product", "cost_price", "not_null", None),
    ("dim_channel", "channel_sk", "not_null", None),
    ("dim_channel", "channel_sk", "unique", None),
    ("dim_channel", "channel_type", "accepted_values",
     ["organic", "google_ads", "yandex_direct", "email", "referral", "social"]),
    ("dim_campaign", "campaign_sk", "not_null", None),
    ("dim_campaign", "campaign_sk", "unique", None),
    ("fact_order_items", "order_item_sk", "not_null", None),
    ("fact_order_items", "order_item_sk", "unique", None),
    ("fact_order_items", "order_id", "not_null", None),
    ("fact_order_items", "date_sk", "not_null", None),
    ("fact_order_items", "customer_sk", "not_null", None),
    ("fact_order_items", "product_sk", "not_null", None),
    ("fact_order_items", "revenue", "not_null", None),
    ("fact_order_items", "cogs", "not_null", None),
    ("fact_sessions", "session_sk", "not_null", None),
    ("fact_sessions", "session_sk", "unique", None),
    ("fact_sessions", "date_sk", "not_null", None),
    ("fact_sessions", "converted", "accepted_values", [0, 1]),
    ("fact_sessions", "is_bounce", "accepted_values", [0, 1]),
    ("fact_fulfillment", "shipment_sk", "not_null", None),
    ("fact_fulfillment", "shipment_sk", "unique", None),
    ("fact_fulfillment", "is_otif", "accepted_values", [0, 1]),
    ("fact_inventory_snapshot", "date_sk", "not_null", None),
    ("fact_inventory_snapshot", "wms_product_id", "not_null", None),
    ("fact_inventory_snapshot", "is_out_of_stock", "accepted_values", [0, 1]),
    ("fact_ad_stats", "ad_stat_sk", "not_null", None),
    ("fact_ad_stats", "campaign_sk", "not_null", None),
    ("fact_ad_stats", "stat_date", "not_null", None),
    ("mart_sales", "report_date", "not_null", None),
    ("mart_sales", "total_revenue", "not_null", None),
    ("mart_sales", "gross_margin_pct", "not_null", None),
    ("mart_marketing", "report_date", "not_null", None),
    ("mart_marketing", "channel_name", "not_null", None),
    ("mart_inventory", "report_date", "not_null", None),
    ("mart_inventory", "otif_rate", "not_null", None),
]


def _in(col: str, values) -> str:
    return f"{col} IN ({', '.join(repr(v) for v in values)})"


# Source CHECK constraints (raw table, predicate).
RANGE_CHECKS = [
    ("raw_web_products", "price > 0"),
    ("raw_web_products", "cost_price > 0"),
    ("raw_web_sessions", "page_views >= 1"),
    ("raw_web_carts", _in("status", CART_STATUSES)),
    ("raw_web_cart_items", "quantity >= 1"),
    ("raw_web_cart_items", "price_at_time > 0"),
    ("raw_web_cart_items", "cost_price > 0"),
    ("raw_web_orders", "total_amount >= 0"),
    ("raw_web_orders", _in("status", ORDER_STATUSES)),
    ("raw_web_order_items", "quantity >= 1"),
    ("raw_web_order_items", "unit_price > 0"),
    ("raw_web_order_items", "unit_cost > 0"),
    ("raw_oms_orders", _in("status", OMS_ORDER_STATUSES)),
    ("raw_oms_returns", _in("status", RETURN_STATUSES)),
    ("raw_wms_products", "unit_cost > 0"),
    ("raw_wms_inventory", "quantity_on_hand >= 0"),
    ("raw_wms_inventory", "quantity_reserved >= 0"),
    ("raw_wms_inventory_movements", "quantity > 0"),
    ("raw_wms_inventory_movements", _in("movement_type", MOVEMENT_TYPES)),
    ("raw_wms_picking_tasks", "quantity >= 1"),
    ("raw_marketing_traffic_sources", _in("channel_type", CHANNEL_TYPES)),
    ("raw_marketing_ad_campaign_daily_stats", "impressions >= 0"),
    ("raw_marketing_ad_campaign_daily_stats", "clicks >= 0"),
    ("raw_marketing_ad_campaign_daily_stats", "spend >= 0"),
    ("raw_marketing_ad_campaign_daily_stats", "conversions >= 0"),
    ("raw_marketing_visits", "duration_sec >= 0"),
    ("raw_marketing_visits", "page_views >= 1"),
    ("raw_marketing_page_events", _in("event_type", PAGE_EVENT_TYPES)),
]

# Source UNIQUE constraints (table, columns), read at the latest version.
UNIQUE_KEYS = [
    ("raw_web_users", ("email",)),
    ("raw_wms_products", ("sku",)),
    ("raw_wms_inventory", ("wms_product_id",)),
    ("raw_marketing_traffic_sources", ("name",)),
    ("raw_marketing_ad_campaign_daily_stats", ("campaign_id", "stat_date")),
    ("raw_marketing_ad_campaign_daily_stats", ("id",)),
]

# Foreign keys (table, column, referenced table, referenced column).
FOREIGN_KEYS = [
    ("raw_web_products", "category_id", "raw_web_categories", "id"),
    ("raw_web_carts", "session_id", "raw_web_sessions", "id"),
    ("raw_web_cart_items", "cart_id", "raw_web_carts", "id"),
    ("raw_web_cart_items", "product_id", "raw_web_products", "id"),
    ("raw_web_orders", "user_id", "raw_web_users", "id"),
    ("raw_web_order_items", "order_id", "raw_web_orders", "id"),
    ("raw_web_order_items", "product_id", "raw_web_products", "id"),
    ("raw_oms_orders", "web_order_id", "raw_web_orders", "id"),
    ("raw_oms_shipments", "oms_order_id", "raw_oms_orders", "id"),
    ("raw_oms_returns", "oms_order_id", "raw_oms_orders", "id"),
    ("raw_wms_products", "web_product_id", "raw_web_products", "id"),
    ("raw_wms_inventory", "wms_product_id", "raw_wms_products", "id"),
    ("raw_wms_inventory_movements", "wms_product_id", "raw_wms_products", "id"),
    ("raw_wms_picking_tasks", "oms_order_id", "raw_oms_orders", "id"),
    ("raw_wms_picking_tasks", "wms_product_id", "raw_wms_products", "id"),
    ("raw_marketing_ad_campaigns", "source_id", "raw_marketing_traffic_sources", "id"),
    ("raw_marketing_ad_campaign_daily_stats", "campaign_id", "raw_marketing_ad_campaigns", "id"),
    ("raw_marketing_visits", "source_id", "raw_marketing_traffic_sources", "id"),
]

# Cross-column invariants (table, name, predicate).
INVARIANTS = [
    ("raw_web_products", "cost_le_price", "cost_price <= price"),
    ("raw_web_sessions", "end_ge_start", "ended_at >= started_at"),
    ("raw_oms_orders", "received_le_confirmed", "received_at <= confirmed_at"),
    ("raw_oms_shipments", "late_means_after_plan",
     "is_on_time <> 0 OR actual_delivery > planned_delivery"),
    ("raw_wms_inventory", "reserved_le_on_hand", "quantity_reserved <= quantity_on_hand"),
    ("raw_marketing_ad_campaigns", "end_ge_start", "end_date >= start_date"),
    ("raw_marketing_ad_campaign_daily_stats", "clicks_le_impressions", "clicks <= impressions"),
    ("raw_marketing_ad_campaign_daily_stats", "conversions_le_clicks", "conversions <= clicks"),
]

# Rate bands (metric, staging model, 0/1 expression, low, high).
RATE_BANDS = [
    ("cart_abandon_rate", "stg_web_carts", "CASE WHEN status = 'abandoned' THEN 1 ELSE 0 END",
     0.20, 0.60),
    ("on_time_rate", "stg_oms_shipments", "is_on_time", 0.75, None),
    ("picking_accuracy", "stg_wms_picking_tasks", "is_accurate", 0.90, None),
    ("substitution_rate", "stg_wms_picking_tasks", "is_substituted", None, 0.15),
    ("bounce_rate", "stg_marketing_visits", "is_bounce", 0.10, 0.60),
]


def model_frames(wh: Warehouse, dim_date: DataFrame) -> dict[str, DataFrame]:
    """The tested models; staging models, which are not written, with the tested columns
    only (the latest version of a row is found whichever of its columns are read)."""
    columns: dict[str, list[str]] = {}
    for m, col, *_ in MODEL_TESTS:
        if col not in columns.setdefault(m, []):
            columns[m].append(col)
    out = {}
    for m in columns:
        if m.startswith("stg_"):
            out[m] = wh.stg(m, columns[m])
        elif m == "dim_date":
            out[m] = dim_date
        elif m.startswith("mart_"):
            out[m] = wh.mart(m)
        else:
            out[m] = getattr(wh, m)
    return out


def _tag(df: DataFrame, name: str, col: str = "model") -> DataFrame:
    return df.select(F.lit(name).alias(col), *df.columns)


def _stack(parts: list[DataFrame]) -> DataFrame:
    """Positional UNION ALL of parts built with one column order and type
    (cheaper to analyse than resolving names part by part)."""
    return reduce(DataFrame.union, parts)


def dq_model_tests(wh: Warehouse, dim_date: DataFrame) -> DataFrame:
    frames = model_frames(wh, dim_date)
    parts = []
    for model in dict.fromkeys(m for m, *_ in MODEL_TESTS):
        checks = []
        for m, col, test, vals in MODEL_TESTS:
            if m != model:
                continue
            checks.append({"not_null": lambda: not_null(col), "unique": lambda: unique(col),
                           "accepted_values": lambda: accepted_values(col, vals)}[test]())
        parts.append(_tag(run_checks(frames[model], checks), model))
    return _stack(parts)


def _per_table(wh: Warehouse, spec, make, read=None) -> DataFrame:
    parts = []
    for table in dict.fromkeys(t for t, *_ in spec):
        checks = [make(wh, row) for row in spec if row[0] == table]
        parts.append(_tag(run_checks((read or (lambda t: _final(wh, t)))(table), checks), table, "table_name"))
    return _stack(parts)


def _final(wh: Warehouse, table: str) -> DataFrame:
    from tidemart.sources.catalog import BY_NAME
    return wh.final(table, BY_NAME[table].keys)


def dq_ranges(wh: Warehouse) -> DataFrame:
    return _per_table(wh, RANGE_CHECKS, lambda w, r: expect(r[1], r[1]))


def dq_unique_keys(wh: Warehouse) -> DataFrame:
    """DQ2/DQ6: single and composite uniqueness, one grouped pass each."""
    return _per_table(wh, UNIQUE_KEYS, lambda w, r: unique(*r[1]),
                      lambda t: wh.final(t, columns=[k for u, ks in UNIQUE_KEYS if u == t for k in ks]))


def dq_orphans(wh: Warehouse) -> DataFrame:
    """JOIN10/DQ5. A parent's keys are the same in all versions of its rows, so they
    are read from the raw table; the child is read at its latest version, key and
    foreign keys only."""
    wanted = {}
    for child, col, *_ in FOREIGN_KEYS:
        wanted.setdefault(child, []).append(col)
    return _per_table(wh, FOREIGN_KEYS, lambda w, r: orphans(r[1], w.raw(r[2]), r[3]),
                      lambda t: wh.final(t, columns=wanted[t]))


def dq_invariants(wh: Warehouse) -> DataFrame:
    return _per_table(wh, INVARIANTS, lambda w, r: expect(r[1], r[2]))


def dq_rate_bands(wh: Warehouse) -> DataFrame:
    """DQ9: one aggregate per staged table, then one row per band."""
    parts = []
    for table in dict.fromkeys(t for _, t, *_ in RATE_BANDS):
        rows = [r for r in RATE_BANDS if r[1] == table]
        agg = wh.stg(table).agg(*[
            band(m, F.sum(F.expr(e)).cast("double") / F.count(F.lit(1)), lo, hi).alias(f"b{i}")
            for i, (m, _, e, lo, hi) in enumerate(rows)])
        parts.append(agg.select(F.explode(F.array(*[F.col(f"b{i}") for i in range(len(rows))]))
                             .alias("b")).select("b.*"))
    return _stack(parts)
