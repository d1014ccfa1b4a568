"""Raw-table catalogue: for each source table the
raw table it loads into, its identity key (dedupe), the extract watermark
column and the column contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RawTable:
    name: str            # raw_<source>_<table>
    source: str          # web / oms / wms / marketing
    table: str           # table name inside the source schema
    keys: tuple          # identity key used by latest()
    ts_col: str          # incremental extract column (strict ts > watermark)
    ddl: str             # column contract, without loaded_at

    @property
    def columns(self) -> list[tuple[str, str]]:
        """(name, type) pairs of the contract (flat DDL, no nested types)."""
        return [tuple(part.strip().split(None, 1)) for part in self.ddl.split(",")]

    @property
    def column_names(self) -> list[str]:
        return [n for n, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        """Contract as a StructType (needs an active Spark session)."""
        return T.StructType.fromDDL(self.ddl)


_TS = "timestamp_ntz"

# The 20 raw tables, their keys, watermark columns and columns.
RAW_TABLES = [
    RawTable("raw_web_categories", "web", "categories", ("id",), "created_at",
             f"id int, name string, parent_id int, created_at {_TS}"),
    RawTable("raw_web_products", "web", "products", ("id",), "created_at",
             f"id long, category_id int, name string, price double, cost_price double, "
             f"is_active int, created_at {_TS}"),
    RawTable("raw_web_users", "web", "users", ("id",), "registered_at",
             f"id long, email string, first_name string, last_name string, city string, "
             f"country string, registered_at {_TS}"),
    RawTable("raw_web_sessions", "web", "sessions", ("id",), "started_at",
             f"id long, user_id long, utm_source string, utm_campaign string, device_type string, "
             f"started_at {_TS}, ended_at {_TS}, page_views long"),
    RawTable("raw_web_carts", "web", "carts", ("id",), "updated_at",
             f"id long, user_id long, session_id long, status string, created_at {_TS}, "
             f"updated_at {_TS}"),
    RawTable("raw_web_cart_items", "web", "cart_items", ("id",), "created_at",
             f"id long, cart_id long, product_id long, quantity int, price_at_time double, "
             f"cost_price double, created_at {_TS}"),
    RawTable("raw_web_orders", "web", "orders", ("id",), "created_at",
             f"id long, user_id long, cart_id long, total_amount double, status string, "
             f"created_at {_TS}"),
    RawTable("raw_web_order_items", "web", "order_items", ("id",), "created_at",
             f"id long, order_id long, product_id long, quantity int, unit_price double, "
             f"unit_cost double, created_at {_TS}"),
    RawTable("raw_oms_orders", "oms", "orders", ("id",), "received_at",
             f"id long, web_order_id long, status string, received_at {_TS}, confirmed_at {_TS}, "
             f"dispatched_at {_TS}, created_at {_TS}"),
    RawTable("raw_oms_shipments", "oms", "shipments", ("id",), "created_at",
             f"id long, oms_order_id long, carrier_id string, tracking_number string, "
             f"planned_delivery date, actual_delivery date, is_on_time int, is_complete int, "
             f"created_at {_TS}"),
    RawTable("raw_oms_returns", "oms", "returns", ("id",), "created_at",
             f"id long, oms_order_id long, reason string, status string, created_at {_TS}"),
    RawTable("raw_wms_products", "wms", "products", ("id",), "created_at",
             f"id long, web_product_id long, sku string, unit_cost double, created_at {_TS}"),
    RawTable("raw_wms_inventory", "wms", "inventory", ("id",), "updated_at",
             f"id long, wms_product_id long, quantity_on_hand int, quantity_reserved int, "
             f"reorder_point int, updated_at {_TS}"),
    RawTable("raw_wms_inventory_movements", "wms", "inventory_movements", ("id",), "created_at",
             f"id long, wms_product_id long, movement_type string, quantity int, created_at {_TS}"),
    RawTable("raw_wms_picking_tasks", "wms", "picking_tasks", ("id",), "created_at",
             f"id long, oms_order_id long, wms_product_id long, quantity int, is_accurate int, "
             f"is_substituted int, completed_at {_TS}, created_at {_TS}"),
    RawTable("raw_marketing_traffic_sources", "marketing", "traffic_sources", ("id",), "created_at",
             f"id int, name string, channel_type string, created_at {_TS}"),
    RawTable("raw_marketing_ad_campaigns", "marketing", "ad_campaigns", ("id",), "created_at",
             f"id int, source_id int, name string, budget double, actual_spend double, "
             f"start_date date, end_date date, created_at {_TS}"),
    RawTable("raw_marketing_ad_campaign_daily_stats", "marketing", "ad_campaign_daily_stats",
             ("campaign_id", "stat_date"), "created_at",
             f"id long, campaign_id int, stat_date date, impressions long, clicks long, "
             f"spend double, conversions long, created_at {_TS}"),
    # Extension: hourly grain of the same ad statistics, feeding the hourly
    # marketing snapshot (the reference only has daily statistics).
    RawTable("raw_marketing_ad_campaign_hourly_stats", "marketing", "ad_campaign_hourly_stats",
             ("campaign_id", "stat_hour"), "created_at",
             f"id long, campaign_id int, stat_hour {_TS}, impressions long, clicks long, "
             f"spend double, conversions long, created_at {_TS}"),
    RawTable("raw_marketing_visits", "marketing", "visits", ("id",), "visited_at",
             f"id long, user_id long, source_id int, utm_campaign string, duration_sec int, "
             f"page_views int, is_bounce int, visited_at {_TS}"),
    RawTable("raw_marketing_page_events", "marketing", "page_events", ("id",), "event_at",
             f"id long, visit_id long, event_type string, page_url string, event_at {_TS}"),
]

BY_NAME = {t.name: t for t in RAW_TABLES}

# Accepted status enumerations of the source tables.
CART_STATUSES = ["active", "abandoned", "converted"]
ORDER_STATUSES = ["pending", "paid", "processing", "shipped", "delivered", "cancelled", "refunded"]
OMS_ORDER_STATUSES = ["received", "confirmed", "dispatched", "delivered", "cancelled"]
RETURN_STATUSES = ["pending", "approved", "rejected", "completed"]
MOVEMENT_TYPES = ["inbound", "outbound", "adjustment", "return"]
CHANNEL_TYPES = ["organic", "google_ads", "yandex_direct", "email", "referral", "social"]
PAGE_EVENT_TYPES = ["pageview", "product_view", "add_to_cart", "checkout", "purchase"]

# The traffic-source (channel) dimension rows (id, name, channel_type).
TRAFFIC_SOURCES = [
    (1, "Google Organic", "organic"),
    (2, "Yandex Organic", "organic"),
    (3, "Google Ads", "google_ads"),
    (4, "Yandex Direct", "yandex_direct"),
    (5, "Email Newsletter", "email"),
    (6, "VK Referral", "referral"),
    (7, "Telegram Social", "social"),
]
