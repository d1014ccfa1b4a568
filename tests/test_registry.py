"""Registered queries read the files that are there when they are called."""
import os
import shutil

from tidemart.plans import marts
from tidemart.plans.registry import queries, warehouse

SF = "/root/testdata/sf0.001"


def test_queries_see_files_added_between_calls(spark, tmp_dir):
    for name in os.listdir(SF):
        if name != "orders.parquet":
            os.symlink(f"{SF}/{name}", f"{tmp_dir}/{name}")
    os.mkdir(f"{tmp_dir}/orders.parquet")
    shutil.copyfile(f"{SF}/orders.parquet", f"{tmp_dir}/orders.parquet/part-0.parquet")
    query = queries()["stg_web_orders"]
    before = query(spark, tmp_dir).count()
    more = spark.read.parquet(f"{SF}/orders.parquet").selectExpr(
        "o_orderkey + 1000000 as o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    more.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/orders.parquet")
    assert query(spark, tmp_dir).count() == before + more.count()


def test_use_drops_memoised_marts(spark):
    wh = warehouse(spark, SF)
    before = wh.model(marts.inventory_turns)
    assert wh.model(marts.inventory_turns) is before
    snap = wh.fact_inventory_snapshot
    wh.use("fact_inventory_snapshot", snap.where("quantity_on_hand > 0"))
    after = wh.model(marts.inventory_turns)
    assert after is not before
    assert after.count() <= before.count()
