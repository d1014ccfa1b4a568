"""The model graph: raw -> staging -> dimensions -> facts.

``Warehouse`` composes models as plain Python functions over DataFrames (the
reference's ``ref()`` edges become attribute accesses). Nothing is
materialised implicitly: each property returns a lazy DataFrame and is
memoised so a query that reads a model twice shares the subtree and Spark
reuses the exchange. ``materialize`` writes chosen models to parquet (the
reference rebuilds facts and marts as tables) and re-reads them, which also
cuts lineage for long jobs."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import (date_sk, day_of_week_mon1, hours_crossed,
                                      seconds_between, week_of_year_sunday)
from tidemart.functions.kpi import MONEY, flag
from tidemart.operators.joins import left_join_defaults, or_join
from tidemart.operators.running import running_min_members
from tidemart.operators.snapshot import latest
from tidemart.plans.staging import STAGING_SPECS, stage
from tidemart.sources.catalog import BY_NAME

c = F.col

# Calendar names used by dim_date.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# The reference spine starts 2023-01-01 and spans 1095 days.
REFERENCE_SPINE = ("2023-01-01", 1095)
# Order statuses excluded from the sales fact.
EXCLUDED_ORDER_STATUSES = ["cancelled", "refunded"]


def date_attribute_map(d) -> dict:
    """dim_date attributes of a DATE column (DIM1, F6-F10, F15), by name."""
    d = c(d) if isinstance(d, str) else d
    dow = day_of_week_mon1(d)
    cols = {
        "date_sk": date_sk(d),
        "date_day": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d)),
        "week_of_year": week_of_year_sunday(d),
        "day_of_week": dow,
        "day_name": F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), dow),
        "is_weekend": F.when(dow.isin(6, 7), 1).otherwise(0),
        "quarter_label": F.concat(F.year(d).cast("string"), F.lit("-Q"),
                                  F.quarter(d).cast("string")),
    }
    return {k: v.alias(k) for k, v in cols.items()}


def date_attributes(d) -> list:
    return list(date_attribute_map(d).values())


class Warehouse:
    """Models over a raw-table provider ``raw(name) -> DataFrame`` and, where the latest
    rows are kept, ``state(name) -> DataFrame`` with one row per key."""

    def __init__(self, raw: Callable[[str], DataFrame], null_mode: str = "ansi",
                 state: Callable[[str], DataFrame] | None = None):
        self._raw = raw
        self._state = state
        self._raw_cache: dict[str, DataFrame] = {}
        self._stg_cache: dict[str, DataFrame] = {}
        self._model_cache: dict[tuple, DataFrame] = {}
        self.null_mode = null_mode

    def use(self, model: str, df: DataFrame) -> None:
        """Replace a dimension or fact by a DataFrame (e.g. the table it was
        written to), so models built afterwards read the table."""
        if not isinstance(getattr(type(self), model, None), cached_property):
            raise ValueError(f"{model} is not a dimension or fact of the warehouse")
        self.__dict__[model] = df
        self._model_cache.clear()  # marts built before now read the old model

    def model(self, fn: Callable[..., DataFrame], **params) -> DataFrame:
        """``fn(self, **params)`` for models defined outside this class (the
        marts), memoised like the dimensions and facts."""
        key = (fn.__module__, fn.__qualname__, tuple(sorted(params.items())))
        if key not in self._model_cache:
            self._model_cache[key] = fn(self, **params)
        return self._model_cache[key]

    def mart(self, name: str) -> DataFrame:
        from tidemart.plans import marts
        return self.model(getattr(marts, name))

    # ---------------------------------------------------------------- raw/staging
    def raw(self, name: str) -> DataFrame:
        if name not in self._raw_cache:
            self._raw_cache[name] = self._raw(name)
        return self._raw_cache[name]

    def stg(self, name: str, columns=None) -> DataFrame:
        """A staging model, or only some of its columns (then no others are read)."""
        key = f"{name}:{','.join(columns)}" if columns else name
        if key not in self._stg_cache:
            raw_name = STAGING_SPECS[name][0]
            self._stg_cache[key] = (stage(self._state(raw_name), name, columns, resolved=True) if self._state
                                    else stage(self.raw(raw_name), name, columns))
        return self._stg_cache[key]

    def final(self, raw_name: str, keys=None, columns=None) -> DataFrame:
        """A raw table read with latest-version semantics (FINAL), on the
        identity key of the catalogue unless ``keys`` is given; with ``columns``,
        only the keys and those."""
        kept = self._state is not None and keys is None
        if keys is None:
            keys = BY_NAME[raw_name].keys if raw_name in BY_NAME else ("id",)
        if kept:
            df = self._state(raw_name)
            return df if columns is None else df.select(*dict.fromkeys([*keys, *columns]))
        key = f"final:{raw_name}:{','.join(keys)}:{'*' if columns is None else ','.join(columns)}"
        if key not in self._stg_cache:
            self._stg_cache[key] = latest(self.raw(raw_name), keys, columns=columns)
        return self._stg_cache[key]

    # ---------------------------------------------------------------- dimensions
    def dim_date(self, start: str, n_days: int) -> DataFrame:
        """Calendar spine of ``n_days`` days from ``start`` (DIM1, SRC12)."""
        spark = self.raw("raw_web_categories").sparkSession
        spine = (spark.range(n_days)
                 .select(F.date_add(F.lit(start).cast("date"), c("id").cast("int")).alias("d")))
        return spine.select(*date_attributes("d"))

    @staticmethod
    def dim_date_from_bounds(bounds: DataFrame) -> DataFrame:
        """Spine covering [lo, hi] of a one-row DataFrame of DATE bounds that
        Spark computed from the data (the span is bounded by the calendar)."""
        return (bounds.select(F.explode(F.sequence(c("lo"), c("hi"))).alias("d"))
                .select(*date_attributes("d")))

    @cached_property
    def dim_customer(self) -> DataFrame:
        u = self.stg("stg_web_users")
        return u.select(
            c("id").alias("customer_sk"), c("id").alias("customer_id"), "email",
            "first_name", "last_name", "city", "country",
            F.to_date("registered_at").alias("registration_date"),
            F.year("registered_at").alias("registration_year"),
            F.month("registered_at").alias("registration_month"))

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.stg("stg_web_products")
        cats = self.stg("stg_web_categories")
        cat = cats.select(c("id").alias("category_id"), c("name").alias("category_name"),
                          c("parent_id"))
        parent = cats.select(c("id").alias("parent_id"), c("name").alias("parent_category_name"))
        j = left_join_defaults(p, cat, ["category_id"], self.null_mode)
        j = left_join_defaults(j, parent, ["parent_id"], self.null_mode)
        return j.select(
            c("id").alias("product_sk"), c("id").alias("product_id"), "product_name", "price",
            "cost_price", "is_active", "category_name", "category_id",
            F.coalesce(c("parent_category_name"), c("category_name")).alias("parent_category_name"))

    @cached_property
    def dim_channel(self) -> DataFrame:
        t = self.final("raw_marketing_traffic_sources")
        return t.select(c("id").alias("channel_sk"), c("id").alias("source_id"),
                        c("name").alias("channel_name"), "channel_type")

    @cached_property
    def dim_campaign(self) -> DataFrame:
        a = self.final("raw_marketing_ad_campaigns")
        return a.select(
            c("id").alias("campaign_sk"), c("id").alias("campaign_id"), "source_id",
            c("name").alias("campaign_name"),
            F.coalesce(c("budget"), F.lit(0.0)).alias("budget"), "actual_spend",
            F.coalesce(c("start_date"), F.lit("2024-01-01").cast("date")).alias("start_date"),
            F.coalesce(c("end_date"), F.lit("2024-12-31").cast("date")).alias("end_date"))

    # ---------------------------------------------------------------- facts
    @cached_property
    def fact_order_items(self) -> DataFrame:
        """FCT1: one row per order line of a kept order; money as DECIMAL(18,2)."""
        return self.order_lines.select(*self.order_item_columns())

    @staticmethod
    def order_item_columns() -> list:
        """The columns of fact_order_items, each from the same row of ``order_lines``."""
        revenue = (c("quantity") * c("unit_price")).cast(MONEY)
        cogs = (c("quantity") * c("unit_cost")).cast(MONEY)
        return [
            c("order_item_sk"), c("order_id"),
            date_sk("order_ts").alias("date_sk"), F.to_date("order_ts").alias("order_date"),
            c("customer_sk"), c("product_sk"), c("quantity"), c("unit_price"), c("unit_cost"),
            revenue.alias("revenue"), cogs.alias("cogs"), (revenue - cogs).alias("gross_profit"),
            c("order_status"), c("is_first_order"), c("order_ts")]

    @cached_property
    def order_lines(self) -> DataFrame:
        """What fact_order_items is made of, without the columns that follow from others.

        is_first_order = (order id == running min of order ids of the customer
        ordered by created_at), evaluated over orders that survive the status
        filter and have at least one line, like the windowed SQL."""
        items = self.stg("stg_web_order_items", ["id", "order_id", "product_id", "quantity", "unit_price", "unit_cost"])
        orders = (self.stg("stg_web_orders", ["id", "user_id", "status", "created_at"])
                  .where(~c("status").isin(*EXCLUDED_ORDER_STATUSES))
                  .select(c("id").alias("order_id"), c("user_id"), c("created_at").alias("order_ts"),
                          c("status").alias("order_status")))
        # The flag belongs to orders, so it is found on orders that have a line and
        # joined to them; the lines, the largest side, are joined once.
        with_lines = orders.join(items.select("order_id"), "order_id", "left_semi")
        first = (running_min_members(with_lines, "user_id", "order_ts", "order_id")
                 .withColumn("is_first_order", F.lit(1)))
        j = items.join(orders.join(first, "order_id", "left"), "order_id", "inner")
        return j.select(
            c("id").alias("order_item_sk"), "order_id", c("user_id").alias("customer_sk"), c("product_id").alias("product_sk"),
            "quantity", "unit_price", "unit_cost", "order_status",
            F.coalesce(c("is_first_order"), F.lit(0)).alias("is_first_order"), "order_ts")

    @cached_property
    def fact_sessions(self) -> DataFrame:
        """FCT2: one row per (session, matching channel). What a session came to is the
        set of the states its carts are in (a handful of values)."""
        s = self.stg("stg_web_sessions", ["id", "user_id", "utm_source", "device_type", "started_at", "ended_at",
                                          "page_views"])
        outcomes = (self.stg("stg_web_carts", ["id", "session_id", "status"]).groupBy("session_id")
                    .agg(F.collect_set("status").alias("outcomes")))
        j = s.join(outcomes.withColumnRenamed("session_id", "id"), "id", "left")
        ended = lambda state: flag(F.coalesce(F.array_contains("outcomes", state), F.lit(False)))       # noqa: E731
        j = or_join(j, "utm_source", self.dim_channel, ["channel_name", "channel_type"],
                    "channel_sk")
        return j.select(
            c("id").alias("session_sk"), date_sk("started_at").alias("date_sk"),
            F.to_date("started_at").alias("session_date"), c("user_id").alias("customer_sk"),
            F.coalesce(c("channel_sk"), F.lit(0)).alias("channel_sk"), "page_views",
            seconds_between("started_at", "ended_at").alias("duration_sec"), "device_type",
            ended("converted").alias("converted"), ended("abandoned").alias("cart_abandoned"),
            flag(c("page_views") == 1).alias("is_bounce"),
            c("started_at").alias("session_start"))

    @cached_property
    def fact_fulfillment(self) -> DataFrame:
        """FCT3: one row per shipment of a known OMS order."""
        return self.shipments.select(*self.fulfillment_columns())

    @staticmethod
    def fulfillment_columns() -> list:
        """The columns of fact_fulfillment, each from the same row of ``shipments``."""
        return [
            c("shipment_sk"), c("oms_order_id"), c("web_order_id"),
            date_sk("shipment_ts").alias("date_sk"), F.to_date("shipment_ts").alias("shipment_date"),
            c("planned_delivery"), c("actual_delivery"), c("is_on_time"), c("is_complete"),
            flag((c("is_on_time") == 1) & (c("is_complete") == 1)).alias("is_otif"),
            c("lead_time_hours"), c("picking_accuracy"), c("substitution_rate"), c("has_return"), c("shipment_ts")]

    @cached_property
    def order_handling(self) -> DataFrame:
        """One row per OMS order with picking tasks or returns: what happened to it in
        the warehouse and after it is stacked and grouped by order once."""
        return (self.stg("stg_wms_picking_tasks", ["id", "oms_order_id", "is_accurate", "is_substituted"])
                .select("oms_order_id", "is_accurate", "is_substituted", F.lit(1).alias("task"), F.lit(0).alias("back"))
                .unionByName(self.final("raw_oms_returns", columns=["oms_order_id"])
                             .select("oms_order_id", F.lit(0).alias("task"), F.lit(1).alias("back")),
                             allowMissingColumns=True)
                .groupBy("oms_order_id").agg(
                    F.sum("task").alias("tasks"), F.max("back").alias("back"),
                    F.avg("is_accurate").alias("accurate"), F.avg("is_substituted").alias("substituted")))

    @cached_property
    def shipments(self) -> DataFrame:
        """What fact_fulfillment is made of, without the columns that follow from others.
        An order without picking tasks counts as picked well, or with type defaults as 0."""
        orders = self.stg("stg_oms_orders", ["id", "web_order_id", "received_at", "dispatched_at"])
        shipped = self.stg("stg_oms_shipments", ["id", "oms_order_id", "planned_delivery", "actual_delivery", "is_on_time",
                                                 "is_complete", "created_at"])
        j = (shipped
             .join(orders.withColumnRenamed("id", "oms_order_id"), "oms_order_id")
             .join(self.order_handling, "oms_order_id", "left"))

        def of_tasks(rate: str, otherwise: float):
            untouched = otherwise if self.null_mode == "ansi" else 0.0
            return F.when(c("tasks") > 0, F.coalesce(c(rate), F.lit(otherwise))).otherwise(untouched)
        return j.select(
            c("id").alias("shipment_sk"), "oms_order_id", "web_order_id",
            "planned_delivery", "actual_delivery", "is_on_time", "is_complete",
            hours_crossed("received_at", "dispatched_at").alias("lead_time_hours"),
            of_tasks("accurate", 1.0).alias("picking_accuracy"), of_tasks("substituted", 0.0).alias("substitution_rate"),
            F.coalesce(c("back"), F.lit(0)).alias("has_return"),
            c("created_at").alias("shipment_ts"))

    @cached_property
    def fact_inventory_snapshot(self) -> DataFrame:
        """FCT4: one row per WMS inventory record at its update date."""
        inv = self.stg("stg_wms_inventory")
        wp = self.final("raw_wms_products", columns=["web_product_id", "unit_cost"]).select(
            c("id").alias("wms_product_id"), "web_product_id", "unit_cost")
        j = left_join_defaults(inv, wp, ["wms_product_id"], self.null_mode)
        on_hand = c("quantity_on_hand")
        return j.select(
            date_sk("updated_at").alias("date_sk"), F.to_date("updated_at").alias("snapshot_date"),
            "wms_product_id", c("web_product_id").alias("product_sk"),
            "quantity_on_hand", "quantity_reserved",
            F.greatest(on_hand - c("quantity_reserved"), F.lit(0)).alias("quantity_available"),
            "reorder_point",
            flag(on_hand <= 0).alias("is_out_of_stock"),
            flag(on_hand <= c("reorder_point")).alias("is_below_reorder"),
            "unit_cost", (on_hand * c("unit_cost")).cast("double").alias("inventory_value"))

    @cached_property
    def fact_ad_stats(self) -> DataFrame:
        """FCT5: one row per campaign x day; ctr is a fraction here."""
        s = self.stg("stg_marketing_ad_stats")
        camp = self.dim_campaign.select("campaign_sk", c("source_id").alias("channel_sk"))
        j = left_join_defaults(s, camp.withColumnRenamed("campaign_sk", "campaign_id"),
                               ["campaign_id"], self.null_mode)
        return j.select(
            c("id").alias("ad_stat_sk"), date_sk("stat_date").alias("date_sk"), "stat_date",
            c("campaign_id").alias("campaign_sk"), "channel_sk",
            "impressions", "clicks", "spend", "conversions",
            F.when(c("impressions") > 0, c("clicks").cast("double") / c("impressions"))
             .otherwise(0.0).alias("ctr"),
            F.when(c("clicks") > 0, c("spend") / c("clicks")).otherwise(0.0).alias("cpc"),
            F.when(c("conversions") > 0, c("spend") / c("conversions")).otherwise(0.0)
             .alias("cost_per_conversion"))
