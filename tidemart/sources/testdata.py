"""Raw warehouse tables derived from the driver's test tables (FIXTURES §3).

The reference loads 20 raw tables from four OLTP sources. The test data is a
TPC-H-like star schema plus an ``events`` click stream, so every raw table
is defined here as a DataFrame computed from those parquet files. Order and
fulfilment tables come from ``orders``/``lineitem``; sessions, carts, ads and
visits from ``events``; purchases in ``events`` also become web orders so that
marts joining orders with sessions see overlapping days.

Derivation rules (the DuckDB oracle in ``tidemart.oracle`` states the same
rules in SQL):
  * lineitem rows carry id = l_orderkey * 8 + l_linenumber; (l_orderkey,
    l_linenumber) repeats in the data, so these tables hold several copies
    of a key and exercise the latest-version read. Version = l_shipdate.
  * a session / cart is one (user_id, day) of events:
    id = user_id * 100000 + days since 2000-01-01.
  * purchase events become orders and order items with id = -(event_id + 1),
    disjoint from the positive TPC-H order keys.
  * nulls, unknown enumerations and orphans are injected with id-modulo
    CASE expressions (never by dropping rows).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.kpi import rnd, sku
from tidemart.sources.catalog import TRAFFIC_SOURCES

# Column contracts of the driver's test tables (as stored in
# their parquet footers). Declaring them skips schema inference at read time.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

FIXED_TS = "2024-01-01 00:00:00"
SESSION_DAY0 = "2000-01-01"


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


class TestData:
    """Reader of ``{sf_dir}/{table}.parquet`` plus the raw-table adapters.

    DataFrames are memoised per instance so one query plan that uses the same
    raw table twice shares the subtree (Spark then reuses the exchange)."""

    __test__ = False  # not a pytest test class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str, cols: list[str] | None = None) -> DataFrame:
        """One scan per table per instance (column pruning still reaches it:
        each caller's select becomes the scan's ReadSchema)."""
        if name not in self._tables:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:
                reader = reader.schema(TABLE_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        df = self._tables[name]
        return df.select(*cols) if cols else df

    # ------------------------------------------------------------ lineitem
    @cached_property
    def _lines(self) -> DataFrame:
        li = self.table("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                     "l_returnflag", "l_linestatus", "l_shipdate"])
        return li.withColumns({"line_id": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
                               "load_seq": F.col("l_partkey") * 1000000 + F.col("l_suppkey")})

    # ------------------------------------------------------------ events
    @cached_property
    def _events(self) -> DataFrame:
        ev = self.table("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
        return (ev.withColumn("k", F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int"))
                  .withColumn("day", F.to_date("ts"))
                  .withColumn("session_id", F.col("user_id") * 100000 +
                              F.datediff(F.to_date("ts"), F.lit(SESSION_DAY0).cast("date"))))

    @cached_property
    def _user_days(self) -> DataFrame:
        e = self._events
        return (e.groupBy("session_id", "user_id", "day")
                 .agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"),
                      F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
                      F.count_if(F.col("event_type") == "click").alias("n_click")))

    @staticmethod
    def _anon_user(uid: Column) -> Column:
        return _null_when(uid % 10 == 0, uid)

    # ------------------------------------------------------------ web
    def raw_web_categories(self) -> DataFrame:
        r = self.table("region", ["r_regionkey", "r_name"])
        n = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        roots = r.select((F.col("r_regionkey") + 1).alias("id"), F.col("r_name").alias("name"),
                         F.lit(None).cast("int").alias("parent_id"))
        leaves = n.select((F.col("n_nationkey") + 100).alias("id"), F.col("n_name").alias("name"),
                          (F.col("n_regionkey") + 1).alias("parent_id"))
        return (roots.unionByName(leaves)
                .withColumn("created_at", _ts(FIXED_TS))
                .withColumn("loaded_at", _ts(FIXED_TS)))

    def raw_web_products(self) -> DataFrame:
        p = self.table("part", ["p_partkey", "p_name", "p_size", "p_retailprice"])
        m = F.col("p_partkey") % 30
        return p.select(
            F.col("p_partkey").alias("id"),
            F.when(m < 25, m + 100).otherwise(m - 24).cast("int").alias("category_id"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            rnd(F.col("p_retailprice") * 0.6, 2).alias("cost_price"),
            F.when(F.col("p_size") % 10 == 0, 0).otherwise(1).alias("is_active"),
            _ts(FIXED_TS).alias("created_at"),
            _ts(FIXED_TS).alias("loaded_at"))

    def raw_web_users(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
        # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H spec.
        n = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        r = self.table("region", ["r_regionkey", "r_name"])
        geo = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey))
        k = F.col("c_custkey")
        return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
            k.alias("id"),
            F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com")).alias("email"),
            _null_when(k % 7 == 0, F.col("c_name")).alias("first_name"),
            _null_when(k % 11 == 0, F.col("c_mktsegment")).alias("last_name"),
            _null_when(k % 13 == 0, F.col("n_name")).alias("city"),
            F.col("r_name").alias("country"),
            F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int"))
             .cast("timestamp_ntz").alias("registered_at"),
            _ts(FIXED_TS).alias("loaded_at")))

    def raw_web_sessions(self) -> DataFrame:
        u = self._user_days
        uid = F.col("user_id")
        utm = (F.when(uid % 6 == 0, "email").when(uid % 6 == 1, "Google Ads")
               .when(uid % 6 == 2, "vk").when(uid % 6 == 3, "ORGANIC")
               .when(uid % 6 == 4, "yandex_direct"))
        return u.select(
            F.col("session_id").alias("id"),
            self._anon_user(uid).alias("user_id"),
            utm.alias("utm_source"),
            _null_when(uid % 4 == 0, F.concat(F.lit("spring_"), (uid % 3).cast("string")))
             .alias("utm_campaign"),
            F.when(uid % 3 == 0, "desktop").when(uid % 3 == 1, "mobile").otherwise("tablet")
             .alias("device_type"),
            F.col("t0").alias("started_at"),
            _null_when(F.col("n") == 1, F.col("t1")).alias("ended_at"),
            F.col("n").alias("page_views"),
            F.col("t1").alias("loaded_at"))

    def raw_web_carts(self) -> DataFrame:
        u = self._user_days
        status = (F.when(F.col("n_purchase") > 0, "converted")
                  .when(F.col("n_click") > 0, "abandoned").otherwise("active"))
        return u.select(
            F.col("session_id").alias("id"),
            self._anon_user(F.col("user_id")).alias("user_id"),
            F.col("session_id"),
            status.alias("status"),
            F.col("t0").alias("created_at"),
            F.col("t1").alias("updated_at"),
            F.col("t1").alias("loaded_at"))

    def raw_web_cart_items(self) -> DataFrame:
        e = self._events.where(F.col("event_type").isin("purchase", "click"))
        eid = F.col("event_id")
        price = F.col("value")
        return e.select(
            eid.alias("id"),
            F.col("session_id").alias("cart_id"),
            F.when(eid % 7 == 0, -1 - F.col("k")).otherwise(F.col("k")).cast("long").alias("product_id"),
            (eid % 3 + 1).cast("int").alias("quantity"),
            price.alias("price_at_time"),
            F.when(eid % 4 == 0, F.lit(None)).when(eid % 4 == 1, F.lit(0.0))
             .otherwise(rnd(price * 0.6, 2)).alias("cost_price"),
            F.col("ts").alias("created_at"),
            F.col("ts").alias("loaded_at"))

    def raw_web_orders(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                  "o_orderpriority"])
        pr = F.substring("o_orderpriority", 1, 1)
        status = (F.when(pr == "1", "paid").when(pr == "2", "shipped").when(pr == "3", "delivered")
                  .when(pr == "4", "refunded").otherwise("cancelled"))
        tpch = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
                        F.lit(None).cast("long").alias("cart_id"),
                        F.col("o_totalprice").alias("total_amount"), status.alias("status"),
                        F.col("o_orderdate").alias("created_at"),
                        F.col("o_orderdate").alias("loaded_at"))
        p = self._events.where(F.col("event_type") == "purchase")
        qty = F.col("event_id") % 3 + 1
        web = p.select((-(F.col("event_id") + 1)).alias("id"), F.col("user_id"),
                       F.col("session_id").alias("cart_id"),
                       (qty * F.col("value")).cast("decimal(18,2)").cast("double").alias("total_amount"),
                       F.lit("paid").alias("status"), F.col("ts").alias("created_at"),
                       F.col("ts").alias("loaded_at"))
        return tpch.unionByName(web)

    def raw_web_order_items(self) -> DataFrame:
        li = self._lines
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        tpch = li.select(F.col("line_id").alias("id"), F.col("l_orderkey").alias("order_id"),
                         F.col("l_partkey").alias("product_id"),
                         F.col("l_quantity").cast("int").alias("quantity"),
                         unit.alias("unit_price"), (unit * 0.6).alias("unit_cost"),
                         F.col("l_shipdate").alias("created_at"),
                         F.col("l_shipdate").alias("loaded_at"), F.col("load_seq"))
        p = self._events.where(F.col("event_type") == "purchase")
        oid = -(F.col("event_id") + 1)
        web = p.select(oid.alias("id"), oid.alias("order_id"), F.col("k").cast("long").alias("product_id"),
                       (F.col("event_id") % 3 + 1).cast("int").alias("quantity"),
                       F.col("value").alias("unit_price"), (F.col("value") * 0.6).alias("unit_cost"),
                       F.col("ts").alias("created_at"), F.col("ts").alias("loaded_at"),
                       F.lit(0).cast("long").alias("load_seq"))
        return tpch.unionByName(web)

    # ------------------------------------------------------------ oms
    def raw_oms_orders(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
        first_ship = (self._lines.groupBy("l_orderkey")
                      .agg(F.min("l_shipdate").alias("first_ship")))
        k = F.col("o_orderkey")
        status = (F.when(F.substring("o_orderpriority", 1, 1) == "5", "cancelled")
                  .when(F.col("o_orderstatus") == "F", "delivered")
                  .when(F.col("o_orderstatus") == "O", "confirmed").otherwise("dispatched"))
        return (o.join(first_ship, o.o_orderkey == first_ship.l_orderkey, "left").select(
            k.alias("id"), k.alias("web_order_id"), status.alias("status"),
            F.col("o_orderdate").alias("received_at"),
            _null_when(k % 5 == 0, F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS"))
             .alias("confirmed_at"),
            F.col("first_ship").alias("dispatched_at"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("loaded_at")))

    def raw_oms_shipments(self) -> DataFrame:
        li = self._lines
        sk = F.col("l_suppkey") % 4
        ship_day = F.to_date("l_shipdate")
        return li.select(
            F.col("line_id").alias("id"), F.col("l_orderkey").alias("oms_order_id"),
            F.when(sk == 1, "DHL").when(sk == 2, "UPS").when(sk == 3, "FedEx").alias("carrier_id"),
            F.concat(F.lit("TRK"), F.col("line_id").cast("string")).alias("tracking_number"),
            _null_when(F.col("l_linenumber") == 7, F.date_add(ship_day, 5)).alias("planned_delivery"),
            _null_when(F.col("l_linestatus") == "O",
                       F.date_add(ship_day, F.col("l_linenumber") + 1)).alias("actual_delivery"),
            F.when(F.col("l_linestatus") == "F", 1).when(F.col("l_linenumber") == 6, F.lit(None))
             .otherwise(0).alias("is_on_time"),
            F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("is_complete"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("loaded_at"), "load_seq")

    def raw_oms_returns(self) -> DataFrame:
        li = self._lines.where(F.col("l_returnflag") == "R")
        ln = F.col("l_linenumber")
        at = F.col("l_shipdate") + F.expr("INTERVAL 10 DAYS")
        return li.select(
            F.col("line_id").alias("id"), F.col("l_orderkey").alias("oms_order_id"),
            F.when(ln % 3 == 0, "damaged").when(ln % 3 == 1, "wrong_item").otherwise("not_needed")
             .alias("reason"),
            F.when(ln % 2 == 1, "approved").otherwise("completed").alias("status"),
            at.alias("created_at"), at.alias("loaded_at"), "load_seq")

    # ------------------------------------------------------------ wms
    def raw_wms_products(self) -> DataFrame:
        p = self.table("part", ["p_partkey", "p_type", "p_retailprice"])
        return p.select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("web_product_id"),
            sku("p_type", "p_partkey").alias("sku"),
            rnd(F.col("p_retailprice") * 0.6, 2).alias("unit_cost"),
            _ts(FIXED_TS).alias("created_at"), _ts(FIXED_TS).alias("loaded_at"))

    def raw_wms_inventory(self) -> DataFrame:
        p = self.table("part", ["p_partkey", "p_size"])
        last = self._lines.groupBy("l_partkey").agg(F.max("l_shipdate").alias("last_ship"))
        upd = F.coalesce(F.col("last_ship"), _ts("1995-01-01 00:00:00"))
        now = p.join(last, p.p_partkey == last.l_partkey, "left").select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("wms_product_id"),
            (F.col("p_size") - 5).alias("quantity_on_hand"),
            (F.col("p_size") % 7).alias("quantity_reserved"),
            F.lit(10).alias("reorder_point"),
            upd.alias("updated_at"), upd.alias("loaded_at"))
        # an older version of every record: a count before the first shipment
        count = _ts("1994-12-31 18:00:00")
        then = p.select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("wms_product_id"),
            (F.col("p_size") * 5).alias("quantity_on_hand"),
            (F.col("p_size") % 7).alias("quantity_reserved"),
            F.lit(10).alias("reorder_point"), count.alias("updated_at"), count.alias("loaded_at"))
        return now.unionByName(then)

    def raw_wms_inventory_movements(self) -> DataFrame:
        li = self._lines
        rf = F.col("l_returnflag")
        return li.select(
            F.col("line_id").alias("id"), F.col("l_partkey").alias("wms_product_id"),
            F.when(rf == "N", "outbound").when(rf == "A", "inbound").otherwise("return")
             .alias("movement_type"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("loaded_at"), "load_seq")

    def raw_wms_picking_tasks(self) -> DataFrame:
        li = self._lines
        return li.select(
            F.col("line_id").alias("id"), F.col("l_orderkey").alias("oms_order_id"),
            F.col("l_partkey").alias("wms_product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_discount") < 0.05, 1).otherwise(0).alias("is_accurate"),
            F.when(F.col("l_tax") > 0.06, 1).otherwise(0).alias("is_substituted"),
            _null_when(F.col("l_linenumber") == 1, F.col("l_shipdate")).alias("completed_at"),
            F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("loaded_at"), "load_seq")

    # ------------------------------------------------------------ marketing
    def raw_marketing_traffic_sources(self) -> DataFrame:
        # An inline JVM-side table: no Python worker is involved.
        rows = F.array(*[F.struct(F.lit(i).cast("int").alias("id"), F.lit(n).alias("name"),
                                  F.lit(t).alias("channel_type")) for i, n, t in TRAFFIC_SOURCES])
        return (self.spark.range(1).select(F.inline(rows))
                .withColumn("created_at", _ts(FIXED_TS))
                .withColumn("loaded_at", _ts(FIXED_TS)))

    @cached_property
    def _campaign_events(self) -> DataFrame:
        return self._events.withColumn("campaign_id", (F.col("k") % 10 + 1).cast("int"))

    def raw_marketing_ad_campaigns(self) -> DataFrame:
        e = self._campaign_events
        cid = F.col("campaign_id")
        g = e.groupBy("campaign_id").agg(
            F.sum(F.when(F.col("event_type") == "view", F.col("value").cast("decimal(18,2)"))
                  .otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double").alias("actual_spend"),
            F.min("day").alias("d0"), F.max("day").alias("d1"),
            F.min("ts").alias("t0"), F.max("ts").alias("t1"))
        return g.select(
            cid.alias("id"), ((cid - 1) % 7 + 1).cast("int").alias("source_id"),
            F.concat(F.lit("Campaign "), cid.cast("string")).alias("name"),
            _null_when(cid % 4 == 0, cid * 1000.0).alias("budget"),
            F.col("actual_spend"),
            _null_when(cid % 3 == 0, F.col("d0")).alias("start_date"),
            _null_when(cid % 5 == 0, F.col("d1")).alias("end_date"),
            F.col("t0").alias("created_at"), F.col("t1").alias("loaded_at"))

    def raw_marketing_ad_campaign_daily_stats(self) -> DataFrame:
        e = self._campaign_events
        g = e.groupBy("campaign_id", "day").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "click").alias("n_click"),
            F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
            F.sum(F.when(F.col("event_type") == "view", F.col("value").cast("decimal(18,2)"))
                  .otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double").alias("spend"),
            F.min("ts").alias("t0"), F.max("ts").alias("t1"))
        return g.select(
            (F.col("campaign_id").cast("long") * 100000 +
             F.datediff("day", F.lit(SESSION_DAY0).cast("date"))).alias("id"),
            "campaign_id", F.col("day").alias("stat_date"),
            (F.col("n") * 1000).alias("impressions"), (F.col("n_click") * 10).alias("clicks"),
            "spend", F.col("n_purchase").alias("conversions"),
            F.col("t0").alias("created_at"), F.col("t1").alias("loaded_at"))

    def raw_marketing_ad_campaign_hourly_stats(self) -> DataFrame:
        e = self._campaign_events.withColumn("stat_hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
        g = e.groupBy("campaign_id", "stat_hour").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "click").alias("n_click"),
            F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
            F.sum(F.when(F.col("event_type") == "view", F.col("value").cast("decimal(18,2)"))
                  .otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double").alias("spend"),
            F.min("ts").alias("t0"), F.max("ts").alias("t1"))
        hours = F.floor((F.unix_seconds(F.col("stat_hour").cast("timestamp")) -
                         F.unix_seconds(F.lit(SESSION_DAY0).cast("timestamp"))) / 3600).cast("long")
        return g.select(
            (F.col("campaign_id").cast("long") * 1000000 + hours).alias("id"),
            "campaign_id", "stat_hour",
            (F.col("n") * 1000).alias("impressions"), (F.col("n_click") * 10).alias("clicks"),
            "spend", F.col("n_purchase").alias("conversions"),
            F.col("t0").alias("created_at"), F.col("t1").alias("loaded_at"))

    def raw_marketing_visits(self) -> DataFrame:
        e = self._events.where(F.col("event_type") == "view")
        eid = F.col("event_id")
        return e.select(
            eid.alias("id"), self._anon_user(F.col("user_id")).alias("user_id"),
            _null_when(eid % 8 == 0, (eid % 7 + 1).cast("int")).alias("source_id"),
            _null_when(eid % 5 == 0, F.concat(F.lit("k"), F.col("k").cast("string"))).alias("utm_campaign"),
            F.floor("value").cast("int").alias("duration_sec"),
            (eid % 5 + 1).cast("int").alias("page_views"),
            F.when(eid % 5 == 0, 1).otherwise(0).alias("is_bounce"),
            F.col("ts").alias("visited_at"), F.col("ts").alias("loaded_at"))

    def raw_marketing_page_events(self) -> DataFrame:
        e = self._events
        et = F.col("event_type")
        mapped = (F.when(et == "view", "pageview").when(et == "click", "product_view")
                  .when(et == "signup", "add_to_cart").when(et == "error", "checkout")
                  .when(et == "purchase", "purchase"))
        return e.select(
            F.col("event_id").alias("id"), F.col("session_id").alias("visit_id"),
            mapped.alias("event_type"),
            _null_when(F.col("event_id") % 9 == 0, F.concat(F.lit("/p/"), F.col("k").cast("string")))
             .alias("page_url"),
            F.col("ts").alias("event_at"), F.col("ts").alias("loaded_at"))

    def raw(self, name: str) -> DataFrame:
        """A raw table with its load sequence: rows of one key and load time differ in it."""
        df = getattr(self, name)()
        return df if "load_seq" in df.columns else df.withColumn("load_seq", F.lit(0).cast("long"))
