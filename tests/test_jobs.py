"""Extract -> load -> build, twice, from the sf0.001 tables."""
import os

from pyspark.sql import functions as F

from tidemart.jobs import _testdata_reader, build_job, extract_job, load_job, raw_reader
from tidemart.operators.snapshot import latest
from tidemart.sources.catalog import BY_NAME
from tidemart.sources.ingest import Watermarks
from tidemart.sources.testdata import TestData

SF = "/root/testdata/sf0.001"


def test_extract_load_build_twice(spark, tmp_dir):
    base, control, raw, out = (os.path.join(tmp_dir, d) for d in ("batches", "control", "raw", "wh"))
    reader = _testdata_reader(spark, SF)
    first = extract_job(spark, reader, base, control, "1990-01-01", ds="2024-02-01")
    assert first["raw_web_orders"] > 0 and first["raw_marketing_page_events"] > 0
    marks = Watermarks(spark, control)
    assert marks.get("web.orders", "1990-01-01") == "2024-01-30"     # day of the newest row
    loaded = load_job(spark, base, raw, "2099-01-01")                 # no batch that day: load all
    assert loaded["raw_web_orders"] == first["raw_web_orders"]

    # second cycle: the strict '> watermark day' predicate re-reads the newest day
    second = extract_job(spark, reader, base, control, "1990-01-01", ds="2024-02-02")
    td = TestData(spark, SF)
    newest_day = td.raw("raw_web_orders").where(F.to_date("created_at") == F.lit("2024-01-30").cast("date")).count()
    assert second["raw_web_orders"] == newest_day
    load_job(spark, base, raw, "2024-02-02")                          # that day's batch exists
    raw_orders = spark.read.parquet(os.path.join(raw, "raw_web_orders"))
    assert raw_orders.count() == first["raw_web_orders"] + newest_day
    # the re-read rows are extra versions: the latest-version read removes them
    keys = BY_NAME["raw_web_orders"].keys
    assert latest(raw_orders, keys).count() == td.raw("raw_web_orders").count()

    res = build_job(spark, raw, out)
    failing = {(r.model, r.check_name, r.column_name) for r in res.tests.collect() if r.violations}
    assert failing <= {("fact_sessions", "unique", "session_sk")}
    wh_orders = spark.read.parquet(os.path.join(out, "core", "fact_order_items"))
    assert wh_orders.count() > 0
