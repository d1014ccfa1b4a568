"""Hourly snapshots on small hand-computed warehouses."""
import datetime as dt

from pyspark.sql import functions as F

from tidemart.plans import hourly, marts
from tidemart.plans.registry import warehouse
from tidemart.plans.warehouse import Warehouse
from tidemart.sources.catalog import BY_NAME

SF = "/root/testdata/sf0.001"


def at(h, d=1):
    return dt.datetime(2024, 6, d, h)


def make(spark, **tables):
    """A warehouse over the given rows; other raw tables are empty. Rows follow the
    contract's columns; loaded_at is fixed."""
    def raw(name):
        cols = BY_NAME[name].ddl
        rows = [(*r, at(0), n) for n, r in enumerate(tables.get(name, []))]
        return spark.createDataFrame(rows, f"{cols}, loaded_at timestamp_ntz, load_seq bigint")
    return Warehouse(raw)


CATALOGUE = {
    "raw_web_categories": [(1, "Root", None, at(0)), (2, "Leaf", 1, at(0))],
    "raw_web_products": [(7, 2, "Lamp", 10.0, 6.0, 1, at(0))],
    "raw_wms_products": [(70, 7, "SKU-A", 6.0, at(0)), (71, 7, "SKU-B", 5.0, at(0))],
    "raw_marketing_traffic_sources": [(1, "Ads", "google_ads", at(0)), (2, "Mail", "email", at(0))],
    "raw_marketing_ad_campaigns": [(5, 1, "C", 100.0, 1.0, None, None, at(0))],
}


def test_hour_with_views_and_no_order(spark):
    wh = make(spark, **CATALOGUE,
              raw_web_orders=[(100, 1, None, 20.0, "paid", at(9))],
              raw_web_order_items=[(1000, 100, 7, 2, 10.0, 6.0, at(9))],
              raw_marketing_page_events=[(1, 11, "add_to_cart", "/p/7", at(10)), (2, 11, "product_view", "/p/7", at(10)),
                                         (3, 12, "product_view", "/p/7", at(10)), (4, 13, "add_to_cart", "/p/7", at(9))])
    got = {r.snapshot_hour.hour: r for r in hourly.hourly_sales(wh).collect()}
    assert set(got) == {9, 10}
    assert (got[9].total_revenue, got[9].total_orders, got[9].cart_adds, got[9].total_sessions) == (20.0, 1, 1, 1)
    assert (got[10].total_revenue, got[10].total_orders, got[10].cart_adds, got[10].total_sessions) == (0.0, 0, 1, 2)
    assert (got[10].cart_abandon_rate, got[10].conversion_rate, got[10].aov) == (100.0, 0.0, 0.0)


def test_spend_without_visits(spark):
    wh = make(spark, **CATALOGUE,
              raw_marketing_ad_campaign_hourly_stats=[(1, 5, at(8), 1000, 10, 50.0, 1, at(8))])
    rows = hourly.hourly_marketing(wh).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.snapshot_hour, r.channel_name, r.channel_type, r.site_traffic, r.total_spend, r.ctr, r.cpc) == (
        at(8), "Ads", "google_ads", 0, 50.0, 1.0, 5.0)


def stock(wms, n, when):
    return (wms, wms, n, 1, 4, when)


def test_stock_is_depleted_from_the_period_start(spark):
    moves = [(1, 70, "outbound", 5, at(6)), (2, 70, "outbound", 3, at(12)), (3, 70, "outbound", 2, at(13)),
             (4, 70, "inbound", 50, at(12)), (5, 71, "outbound", 1, at(12))]
    wh = make(spark, **CATALOGUE, raw_wms_inventory=[stock(70, 40, at(0)), stock(70, 20, at(11)), stock(70, 3, at(20)),
                                                     stock(71, 9, at(10))],
              raw_wms_inventory_movements=[(i, w, k, q, t) for i, w, k, q, t in moves])
    got = {(r.snapshot_hour.hour, r.sku): r for r in hourly.hourly_inventory(wh, "2024-06-01 12:00:00").collect()}
    # the 6 o'clock movement is before the period, the 20 o'clock record after its start;
    # two WMS products of one web product keep their own stock and rows
    assert set(got) == {(12, "SKU-A"), (13, "SKU-A"), (12, "SKU-B")}
    assert got[12, "SKU-A"].quantity_on_hand == 17 and got[13, "SKU-A"].quantity_on_hand == 15
    assert got[12, "SKU-B"].quantity_on_hand == 8 and got[12, "SKU-B"].quantity_available == 7
    assert got[13, "SKU-A"].daily_sales_avg == 5.0 and got[13, "SKU-A"].days_supply == 2.8


def test_low_stock_is_topped_up_in_the_first_hour(spark):
    wh = make(spark, **CATALOGUE, raw_wms_inventory=[stock(70, 5, at(0))],
              raw_wms_inventory_movements=[(1, 70, "outbound", 3, at(5)), (2, 70, "outbound", 1, at(6))])
    got = {r.snapshot_hour.hour: r.quantity_on_hand for r in hourly.hourly_inventory(wh, "2024-06-01 00:00:00").collect()}
    assert got == {5: 2 + 10, 6: 1}


def test_totals_equal_their_inputs(spark):
    wh = warehouse(spark, SF)
    sales = hourly.hourly_sales(wh).agg(F.sum("total_revenue").cast("decimal(18,2)"), F.sum("total_units")).first()
    lines = wh.fact_order_items.join(wh.dim_product, "product_sk").agg(F.sum("revenue"), F.sum("quantity")).first()
    assert tuple(sales) == tuple(lines)
    spend = hourly.hourly_marketing(wh).agg(F.sum("total_spend").cast("decimal(18,2)")).first()[0]
    ads = wh.final("raw_marketing_ad_campaign_hourly_stats", ("campaign_id", "stat_hour"))
    assert spend == ads.agg(F.sum(F.col("spend").cast("decimal(18,2)"))).first()[0]


def test_approximate_distinct_counts(spark):
    wh = warehouse(spark, SF)
    exact = wh.model(marts.mart_sales).agg(F.sum("total_orders")).first()[0]
    near = marts.mart_sales(wh, approx_distinct=True).agg(F.sum("total_orders")).first()[0]
    assert abs(near - exact) <= 0.05 * exact


def test_registered_period_covers_all_movements(spark):
    from tidemart.plans.registry import HOURLY_START
    wh = warehouse(spark, SF)
    hours = wh.model(hourly.hourly_inventory, start=HOURLY_START).agg(F.sum("hourly_outbound_qty")).first()[0]
    moved = wh.stg("stg_wms_inventory_movements").where("movement_type = 'outbound'").agg(F.sum("quantity")).first()[0]
    assert hours == moved > 0
