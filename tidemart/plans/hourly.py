"""Hourly KPI snapshots HR1-HR3.

The reference declares three hourly tables and fills them with simulated
rows; here they are computed from the facts with the KPI formulas of that
simulation as the contract:
  sales:      abandon % = (cart adds - orders) / cart adds, repeat = unique - new,
              estimated LTV = AOV x expected lifetime orders (parameter);
  marketing:  time on site in minutes, visits per unique visitor, CPA, ROAS,
              ROMI, CAC, content-channel (blog) and long (chat) sessions;
  inventory:  stock depleted by cumulative hourly outbound with a one-time
              top-up in the first hour when below the reorder point,
              days of supply = available / average daily outbound (else 0),
              annual turns = 365 / days of supply, GMROI = margin x turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.dates import hour_start
from tidemart.functions.kpi import MONEY, mean, ratio, ratio_pct, rnd
from tidemart.operators.running import running_sum
from tidemart.operators.snapshot import latest
from tidemart.plans.marts import order_customer_rollup, product_groups, session_channels_per_customer_day
from tidemart.plans.warehouse import Warehouse

c = F.col

# Channel types counted as content (blog) sessions.
CONTENT_CHANNEL_TYPES = ["organic", "email"]


def _all_keys(keys: list[str], *parts: DataFrame) -> DataFrame:
    """The parts side by side on every key that any of them has (null keys too):
    each part has one row per key, so stacking them and taking the one value there
    is joins them in a single shuffle."""
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(x).alias(x) for x in stacked.columns if x not in keys])


def _zero(name: str):
    return F.coalesce(c(name), F.lit(0))


def hourly_sales(wh: Warehouse, ltv_orders: float = 10.0) -> DataFrame:
    """HR1: per (hour, category, product) with a sale, a product view or a cart add."""
    p = wh.dim_product.select("product_sk", "category_name", "product_name")
    f = wh.fact_order_items.withColumn("snapshot_hour", hour_start("order_ts"))
    keys = ["snapshot_hour", "category_name", "product_name"]
    group_of, groups = product_groups(p, keys[1:])
    sales = (order_customer_rollup(f.join(group_of, "product_sk", "inner"), ["snapshot_hour", "product_group"], extra_first=True)
             .join(groups, "product_group", "inner").drop("product_group"))
    # events are reduced to (hour, product, visit) before they meet the product
    pe = (wh.final("raw_marketing_page_events", columns=["event_at", "visit_id", "event_type", "page_url"])
          .select(hour_start("event_at").alias("snapshot_hour"), "visit_id", "event_type",
                  F.regexp_extract("page_url", r"^/p/(\d+)$", 1).alias("pid"))
          .where(c("pid") != "").withColumn("product_sk", c("pid").try_cast("long"))
          .groupBy("snapshot_hour", "product_sk", "visit_id")
          .agg(F.max(F.when(c("event_type") == "add_to_cart", 1).otherwise(0)).alias("added"),
               F.max(F.when(c("event_type") == "purchase", 1).otherwise(0)).alias("bought")))
    per_visit = pe.join(p, "product_sk", "inner").groupBy(*keys, "visit_id").agg(
        F.max("added").alias("added"), F.max("bought").alias("bought"))
    funnel = per_visit.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_sessions"), F.sum("added").cast("long").alias("cart_adds"),
        F.sum("bought").cast("long").alias("converted_sessions"))
    j = _all_keys(keys, sales, funnel)
    j = j.select(*keys, *[F.coalesce(c(k), F.lit(0).cast(MONEY)).alias(k) for k in ("rev", "cogs", "gp")],
                 *[_zero(k).alias(k) for k in ("total_orders", "total_units", "unique_customers", "new_customers",
                                               "total_sessions", "cart_adds", "converted_sessions")])
    aov = ratio("rev", "total_orders")
    return j.select(
        *keys,
        c("rev").cast("double").alias("total_revenue"), c("cogs").cast("double").alias("total_cogs"),
        c("gp").cast("double").alias("gross_profit"), ratio_pct("gp", "rev").alias("gross_margin_pct"),
        "total_orders", "total_units", aov.alias("aov"),
        ratio("total_units", "total_orders").alias("avg_items_per_order"),
        "total_sessions", "cart_adds", "converted_sessions",
        ratio_pct("total_orders", "total_sessions").alias("conversion_rate"),
        ratio_pct(c("cart_adds") - c("total_orders"), "cart_adds").alias("cart_abandon_rate"),
        "unique_customers", "new_customers",
        (c("unique_customers") - c("new_customers")).alias("repeat_customers"),
        F.when(aov > 0, rnd(aov * float(ltv_orders), 2)).otherwise(0.0).alias("estimated_ltv"))


def hourly_marketing(wh: Warehouse, chat_min_pages: int = 5) -> DataFrame:
    """HR2: per (hour, channel) with visits, ad statistics or attributed revenue."""
    ch = wh.dim_channel.select("channel_sk", "channel_name", "channel_type")
    keys = ["snapshot_hour", "channel_name"]
    s = (wh.fact_sessions.join(ch, "channel_sk", "left")
         .withColumn("snapshot_hour", hour_start("session_start"))
         .withColumn("channel_name", F.coalesce(c("channel_name"), F.lit(""))))
    visits = s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("site_traffic"),
        F.countDistinct("customer_sk").alias("unique_visitors"),
        mean("duration_sec").alias("avg_dur"),
        rnd(mean("is_bounce") * 100, 2).alias("bounce_rate"),
        F.sum("converted").cast("long").alias("conversions"),
        F.count_if(c("channel_type").isin(*CONTENT_CHANNEL_TYPES)).alias("blog_sessions"),
        F.count_if(c("page_views") >= chat_min_pages).alias("chat_sessions_initiated"))
    camp = wh.dim_campaign.select(c("campaign_sk").alias("campaign_id"), c("source_id").alias("channel_sk"))
    hs = wh.final("raw_marketing_ad_campaign_hourly_stats", ("campaign_id", "stat_hour"),
                  ["impressions", "clicks", "spend"])
    ads = (hs.join(camp, "campaign_id", "left").join(ch.drop("channel_type"), "channel_sk", "left")
           .groupBy(hour_start("stat_hour").alias("snapshot_hour"),
                    F.coalesce(c("channel_name"), F.lit("")).alias("channel_name"))
           .agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                F.sum(c("spend").cast(MONEY)).alias("spend_d")))
    lines = (wh.fact_order_items
             .groupBy("customer_sk", c("order_date").alias("day"),
                      hour_start("order_ts").alias("snapshot_hour"))
             .agg(F.sum("revenue").alias("rev"), F.count_if(c("is_first_order") == 1).alias("nf")))
    sess = wh.model(session_channels_per_customer_day, dedupe="none")
    w = F.coalesce(c("n"), F.lit(1))
    rev = (lines.join(sess, ["customer_sk", "day"], "left")
           .groupBy("snapshot_hour", F.coalesce(c("channel_name"), F.lit("")).alias("channel_name"))
           .agg(F.sum(c("rev") * w).alias("rev_d"), F.sum(c("nf") * w).alias("new_customers")))
    types = wh.dim_channel.groupBy("channel_name").agg(F.min("channel_type").alias("channel_type"))
    j = _all_keys(keys, visits, ads, rev).join(types, "channel_name", "left")
    counts = ("site_traffic", "unique_visitors", "conversions", "blog_sessions", "chat_sessions_initiated",
              "impressions", "clicks", "new_customers")
    j = j.select(*keys, F.coalesce(c("channel_type"), F.lit("")).alias("channel_type"),
                 *[_zero(k).cast("long").alias(k) for k in counts],
                 *[F.coalesce(c(k).cast("double"), F.lit(0.0)).alias(k)
                   for k in ("avg_dur", "bounce_rate", "spend_d", "rev_d")])
    spend, revenue, newc = c("spend_d"), c("rev_d"), c("new_customers")
    return j.select(
        "snapshot_hour", "channel_name", "channel_type", "site_traffic", "unique_visitors",
        rnd("avg_dur", 1).alias("avg_session_duration_sec"),
        rnd(c("avg_dur") / 60.0, 2).alias("avg_time_on_site_min"),
        "bounce_rate", ratio("site_traffic", "unique_visitors").alias("visit_frequency_avg"),
        "conversions", "impressions", "clicks",
        ratio_pct("clicks", "impressions").alias("ctr"), ratio(spend, "clicks").alias("cpc"),
        rnd(spend, 2).alias("total_spend"), ratio(spend, "conversions").alias("cpa"),
        revenue.alias("attributed_revenue"), ratio(revenue, spend).alias("roas"),
        F.when(spend > 0, rnd((revenue - spend) / spend * 100, 2)).otherwise(0.0).alias("romi"),
        newc, ratio(spend, newc).alias("cac"),
        "blog_sessions", "chat_sessions_initiated")


def stock_as_of(wh: Warehouse, start: str | None) -> DataFrame:
    """Per WMS product the stock at the start of the period: the newest record at or
    before ``start``, or without one the oldest record; ``since`` is the period's start."""
    inv = wh.raw("raw_wms_inventory")
    cols = ["quantity_on_hand", "quantity_reserved", "reorder_point"]
    if start is None:
        first = inv.groupBy("wms_product_id").agg(
            F.min(F.struct("updated_at", "loaded_at", "load_seq", *cols)).alias("s"))
        return first.select("wms_product_id", *[c(f"s.{k}").alias(k) for k in cols],
                            hour_start("s.updated_at").alias("since"))
    at = F.lit(start).cast("timestamp_ntz")
    return (latest(inv.where(c("updated_at") <= at), ["wms_product_id"], "updated_at",
                   tiebreak=["loaded_at", "load_seq"], columns=cols)
            .withColumn("since", at))


def hourly_inventory(wh: Warehouse, start: str | None = None, topup_factor: float = 2.5) -> DataFrame:
    """HR3: per (hour with outbound movement, WMS product) of a period. Stock starts from
    what was on hand at the period's start and is depleted by the outbound
    movements from then on; a product of unknown stock has none."""
    wp = wh.final("raw_wms_products", columns=["web_product_id", "sku", "unit_cost"]).select(
        c("id").alias("wms_product_id"), c("web_product_id").alias("product_sk"), "sku", "unit_cost")
    im = wh.stg("stg_wms_inventory_movements").where(c("movement_type") == "outbound")
    if start is not None:
        im = im.where(c("created_at") >= F.lit(start).cast("timestamp_ntz"))
    stock = stock_as_of(wh, start)
    hourly = (im.groupBy("wms_product_id", hour_start("created_at").alias("snapshot_hour"))
              .agg(F.sum("quantity").cast("long").alias("hourly_outbound_qty"))
              .join(stock.select("wms_product_id", "since"), "wms_product_id", "left")
              .where(c("since").isNull() | (c("snapshot_hour") >= c("since"))).drop("since"))
    daily_avg = (hourly.groupBy("wms_product_id", F.to_date("snapshot_hour").alias("d"))
                 .agg(F.sum("hourly_outbound_qty").alias("q"))
                 .groupBy("wms_product_id").agg(mean("q").alias("daily_avg")))
    p = wh.dim_product.select("product_sk", "category_name", "product_name", "price", "cost_price")
    h = running_sum(hourly, "wms_product_id", "snapshot_hour", "hourly_outbound_qty", "cum_out")
    h = h.withColumn("first_hour", F.min("snapshot_hour").over(Window.partitionBy("wms_product_id")))
    j = (h.join(stock.drop("since"), "wms_product_id", "left").join(daily_avg, "wms_product_id", "left")
          .join(wp, "wms_product_id", "left").join(p, "product_sk", "left"))
    for k in ("quantity_on_hand", "quantity_reserved", "reorder_point"):
        j = j.withColumn(k, _zero(k))
    depleted = F.greatest(c("quantity_on_hand") - c("cum_out"), F.lit(0))
    topup = F.when((c("snapshot_hour") == c("first_hour")) & (depleted < c("reorder_point")),
                   rnd(c("reorder_point") * float(topup_factor), 0).cast("long")).otherwise(0)
    j = j.withColumn("on_hand", (depleted + topup).cast("long"))
    j = j.withColumn("reserved", F.least(c("quantity_reserved").cast("long"), c("on_hand")))
    j = j.withColumn("available", F.greatest(c("on_hand") - c("reserved"), F.lit(0)))
    j = j.withColumn("days_supply", F.when((c("daily_avg") > 0) & (c("available") > 0),
                                           rnd(c("available") / c("daily_avg"), 1)).otherwise(0.0))
    j = j.withColumn("turns", F.when(c("days_supply") > 0, rnd(365.0 / c("days_supply"), 2))
                     .otherwise(0.0))
    margin = F.when(c("price") > 0, (c("price") - c("cost_price")) / c("price")).otherwise(0.0)
    fl = _fulfillment_hourly(wh)
    j = j.join(fl, "snapshot_hour", "left")
    oos = F.when(c("available") == 0, 1).otherwise(0)
    return j.select(
        "snapshot_hour", "category_name", "product_name", "sku", "unit_cost",
        c("on_hand").alias("quantity_on_hand"), c("reserved").alias("quantity_reserved"),
        c("available").alias("quantity_available"), "reorder_point",
        rnd(c("on_hand") * c("unit_cost"), 2).alias("inventory_value"),
        oos.alias("is_out_of_stock"),
        F.when(c("on_hand") < c("reorder_point"), 1).otherwise(0).alias("is_below_reorder"),
        "hourly_outbound_qty", rnd("daily_avg", 1).alias("daily_sales_avg"), "days_supply",
        c("turns").alias("inventory_turns_annual"),
        F.when(c("turns") > 0, rnd(margin * c("turns"), 2)).otherwise(0.0).alias("gmroi"),
        F.coalesce(c("total_shipments"), F.lit(0)).alias("total_shipments"),
        *[F.coalesce(c(k), F.lit(0.0)).alias(k) for k in
          ["otif_rate", "order_accuracy", "substitution_rate", "return_rate",
           "avg_lead_time_hours", "damage_free_rate"]],
        oos.alias("out_of_stock_events"))


def _fulfillment_hourly(wh: Warehouse) -> DataFrame:
    f = wh.fact_fulfillment.withColumn("snapshot_hour", hour_start("shipment_ts"))
    return f.groupBy("snapshot_hour").agg(
        F.count(F.lit(1)).alias("total_shipments"),
        rnd(mean("is_otif") * 100, 2).alias("otif_rate"),
        rnd(F.avg("picking_accuracy") * 100, 2).alias("order_accuracy"),
        rnd(F.avg("substitution_rate") * 100, 2).alias("substitution_rate"),
        rnd(mean("has_return") * 100, 2).alias("return_rate"),
        rnd(mean("lead_time_hours"), 1).alias("avg_lead_time_hours"),
        rnd(mean("is_complete") * 100, 2).alias("damage_free_rate"))
