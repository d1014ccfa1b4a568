"""The three scheduled jobs of the warehouse, as Spark jobs.

  extract  for every catalogued source table: watermark -> rows newer than it
           -> batch under {base}/{source}/{table}/ds=<run day>/run=<id> -> advance
           the watermark (data first, then the mark).
  load     every table's batches of the run day, or all of its batches when
           that day has none -> type repair by contract -> loaded_at and the
           batches' order -> append to the raw table. Re-loaded rows become extra versions resolved at
           read time. A source table without any batch is left alone.
  build    raw tables -> staging -> dimensions/facts (written) -> marts
           (written) -> model tests.

usage:
  python -m tidemart.jobs extract --sf-dir DIR --base DIR --control DIR [--init-date D] [--ds D]
  python -m tidemart.jobs load    --base DIR --raw DIR [--state DIR] [--ds YYYY-MM-DD]
  python -m tidemart.jobs build   --raw DIR [--state DIR] --out DIR
The extract job reads the source tables through the test-data adapters
(``--sf-dir``); with real sources, pass a reader to ``extract_job``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.pipeline import BuildResult, build_all
from tidemart.plans.warehouse import Warehouse
from tidemart.sources.catalog import BY_NAME, RAW_TABLES, RawTable
from tidemart.sources.keyed import LatestState
from tidemart.sources.ingest import Watermarks, extract_source, load_batches, new_run_id, read_raw

SOURCES = ["web", "oms", "wms", "marketing"]


def extract_job(spark: SparkSession, read_table: Callable[[RawTable], DataFrame], base: str,
                control: str, init_date: str, lookback_days: int = 0,
                ds: str | None = None) -> dict:
    marks = Watermarks(spark, control)
    run = new_run_id()
    out = {}
    for source in SOURCES:
        out.update(extract_source(spark, source, read_table, base, marks, init_date,
                                  lookback_days=lookback_days, run_date=ds, run=run))
    return out


def load_job(spark: SparkSession, base: str, raw_dir: str, ds: str, skip_unreadable: bool = False,
             state_dir: str | None = None) -> dict:
    """``state_dir``: where the latest rows of every raw table are kept; the loads it lacks are merged."""
    out = {}
    for t in RAW_TABLES:
        out[t.name] = load_batches(spark, base, raw_dir, t, ds, skip_unreadable)
        if state_dir:
            state = LatestState(spark, state_dir, t)
            state.refresh(read_raw(spark, raw_dir, t))
            state.kept.forget()
    return out


def raw_reader(spark: SparkSession, raw_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: read_raw(spark, raw_dir, BY_NAME[name])


def state_reader(spark: SparkSession, state_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: LatestState(spark, state_dir, BY_NAME[name]).read()


def build_job(spark: SparkSession, raw_dir: str, out_dir: str, state_dir: str | None = None) -> BuildResult:
    """With ``state_dir``, the models read the kept latest rows and not the raw history."""
    state = state_reader(spark, state_dir) if state_dir else None
    return build_all(spark, Warehouse(raw_reader(spark, raw_dir), state=state), out_dir)


def _testdata_reader(spark: SparkSession, sf_dir: str):
    from tidemart.sources.testdata import TestData
    td = TestData(spark, sf_dir)
    return lambda t: td.raw(t.name).drop("loaded_at", "load_seq")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemart.jobs")
    ap.add_argument("job", choices=["extract", "load", "build"])
    ap.add_argument("--sf-dir")
    ap.add_argument("--base")
    ap.add_argument("--control")
    ap.add_argument("--raw")
    ap.add_argument("--state")
    ap.add_argument("--out")
    ap.add_argument("--init-date", default="2020-01-01")
    ap.add_argument("--ds", default=dt.date.today().isoformat())
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    from tidemart.session import build_session
    spark = build_session(a.master)
    if a.job == "extract":
        print(extract_job(spark, _testdata_reader(spark, a.sf_dir), a.base, a.control, a.init_date, ds=a.ds))
    elif a.job == "load":
        print(load_job(spark, a.base, a.raw, a.ds, state_dir=a.state))
    else:
        res = build_job(spark, a.raw, a.out, a.state)
        bad = res.tests.where(F.col("violations") > 0).collect()
        print({"tables": res.tables, "failing_tests": [r.asDict() for r in bad]})


if __name__ == "__main__":
    main()
