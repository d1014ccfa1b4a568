"""The scheduled model build: staging -> core -> marts -> tests.

Staging stays lazy (views in the reference). Dimensions and facts are
written once as tables, facts partitioned by toYYYYMM(date) and sorted by
their order key, and the marts are then built from the written facts: each
fact is computed once even though several marts read it, and the marts'
plans start from parquet (lineage is cut at the table boundary). The model
tests run last over the written tables.

The large facts are written one after another, before that of shipments what
happened to their orders, and what a write shuffled is deleted when it ends: the
executors' disks hold the shuffles of one large write, not those of the build."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemart.plans import checks, hourly, marts
from tidemart.plans.warehouse import Warehouse
from tidemart.session import shuffles_freed
from tidemart.sources.batch_io import write_partitioned_sorted

# Table layout of the core and mart models
# (model -> (date column for the month partition, sort key)).
FACT_LAYOUT = {
    "fact_order_items": ("order_date", ["order_date", "customer_sk", "product_sk"]),
    "fact_sessions": ("session_date", ["session_date", "customer_sk", "channel_sk"]),
    "fact_fulfillment": ("shipment_date", ["shipment_date", "shipment_sk"]),
    "fact_inventory_snapshot": ("snapshot_date", ["snapshot_date", "wms_product_id"]),
    "fact_ad_stats": ("stat_date", ["stat_date", "campaign_sk"]),
}
# The large facts: the rows they are computed from, row by row once those are at their
# month, the moment that names the month, and their columns.
FACT_ROWS = {
    "fact_order_items": ("order_lines", "order_ts", "order_item_columns"),
    "fact_fulfillment": ("shipments", "shipment_ts", "fulfillment_columns"),
}
DIM_ORDER = {
    "dim_customer": "customer_sk",
    "dim_product": "product_sk",
    "dim_channel": "channel_sk",
    "dim_campaign": "campaign_sk",
}
MART_LAYOUT = {
    "mart_sales": ("report_date", ["report_date", "category_name", "product_name"]),
    "mart_marketing": ("report_date", ["report_date", "channel_name"]),
    "mart_inventory": ("report_date", ["report_date", "product_name"]),
}
HOURLY_LAYOUT = {
    "hourly_sales": ["snapshot_hour", "category_name", "product_name"],
    "hourly_marketing": ["snapshot_hour", "channel_name"],
    "hourly_inventory": ["snapshot_hour", "category_name", "product_name"],
}


def _together(jobs: list) -> None:
    """Runs independent writes side by side (Spark shares the executors between
    their jobs); the first failure is raised."""
    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(j) for j in jobs]:
            done.result()


def _in_turn(jobs: list) -> None:
    """Runs writes one after another."""
    for j in jobs:
        j()


@dataclass
class BuildResult:
    out_dir: str
    tables: list[str]
    tests: DataFrame


def build_all(spark: SparkSession, wh: Warehouse, out_dir: str,
              spine: tuple[str, int] | None = None, with_hourly: bool = True) -> BuildResult:
    out = out_dir.rstrip("/")
    with shuffles_freed(spark):
        written = _write_models(spark, wh, out, spine, with_hourly)
    read = {n: spark.read.parquet(f"{out}/datamart/{n}").drop("yyyymm") for n in MART_LAYOUT}
    tests = checks.dq_model_tests(_MartView(wh, read), spark.read.parquet(f"{out}/core/dim_date"))
    return BuildResult(out, written, tests)


def _write_models(spark: SparkSession, wh: Warehouse, out: str, spine, with_hourly: bool) -> list[str]:
    bounds = wh.raw("raw_web_orders").selectExpr("to_date(min(created_at)) AS lo",
                                                 "to_date(max(created_at)) AS hi")
    dim_date = Warehouse.dim_date_from_bounds(bounds) if spine is None else wh.dim_date(*spine)
    dims = {name: getattr(wh, name).hint("rebalance", key).sortWithinPartitions(key) for name, key in DIM_ORDER.items()}
    dims["dim_date"] = dim_date
    _together([partial(df.write.mode("overwrite").parquet, f"{out}/core/{name}") for name, df in dims.items()])
    for name in DIM_ORDER:
        wh.use(name, spark.read.parquet(f"{out}/core/{name}"))

    def write_rows(name: str) -> None:
        rows, moment, columns = FACT_ROWS[name]
        write_partitioned_sorted(getattr(wh, rows), f"{out}/core/{name}", moment, FACT_LAYOUT[name][1],
                                 columns=getattr(wh, columns)())

    def write_handling() -> None:
        df, path = wh.order_handling, f"{out}/intermediate/order_handling"
        df.write.mode("overwrite").parquet(path)
        wh.use("order_handling", spark.read.schema(df.schema).parquet(path))

    facts = {name: (getattr(wh, name), *layout) for name, layout in FACT_LAYOUT.items() if name not in FACT_ROWS}
    large = [write_handling, *[partial(write_rows, name) for name in FACT_ROWS]]
    _together([partial(_in_turn, large), *[partial(write_partitioned_sorted, df, f"{out}/core/{name}", date_col, order)
                                           for name, (df, date_col, order) in facts.items()]])
    for name in FACT_LAYOUT:
        wh.use(name, spark.read.parquet(f"{out}/core/{name}").drop("yyyymm"))
    written = [*dims, *FACT_LAYOUT]
    built = {
        "mart_sales": marts.mart_sales(wh, spine),
        "mart_marketing": marts.mart_marketing(wh),
        "mart_inventory": marts.mart_inventory(wh),
    }
    jobs = [partial(write_partitioned_sorted, built[name], f"{out}/datamart/{name}", date_col, order)
            for name, (date_col, order) in MART_LAYOUT.items()]
    written += MART_LAYOUT
    if with_hourly:
        jobs += [partial(write_partitioned_sorted, getattr(hourly, name)(wh), f"{out}/datamart/{name}",
                         "snapshot_hour", order, grain="day") for name, order in HOURLY_LAYOUT.items()]
        written += HOURLY_LAYOUT
    _together(jobs)
    return written


class _MartView:
    """Warehouse facade whose marts are the written mart tables."""

    def __init__(self, wh: Warehouse, mart_tables: dict[str, DataFrame]):
        self._wh, self._marts = wh, mart_tables

    def __getattr__(self, name):
        return getattr(self._wh, name)

    def mart(self, name: str) -> DataFrame:
        return self._marts[name]
