"""What a model build holds on disk: the shuffles of one large write at a time."""
import time
from pathlib import Path

from pyspark.sql import functions as F

from tidemart.plans import pipeline
from tidemart.plans.registry import warehouse
from tidemart.session import FREE_SHUFFLES, shuffles_freed
from tidemart.sources.batch_io import write_partitioned_sorted

SF = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> set[str]:
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in dirs for f in Path(d).rglob("shuffle_*.data")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files beside those of ``before``; deletions take a moment."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_shuffles_of_a_write_go_when_it_ends(spark, tmp_dir):
    before, setting = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_freed(spark):
        df.write.parquet(f"{tmp_dir}/t")
    assert not _left(spark, before)
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert sorted(r["count"] for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [142] * 1 + [143] * 6
    assert df.count() == 7      # a query that runs again shuffles again


def test_build_writes_large_facts_in_turn_and_leaves_no_shuffles(spark, tmp_dir, monkeypatch):
    spans = {}

    def write(df, path, *args, **kw):
        name = path.rsplit("/", 1)[1]
        spans[name] = [time.monotonic()]
        write_partitioned_sorted(df, path, *args, **kw)
        spans[name].append(time.monotonic())

    monkeypatch.setattr(pipeline, "write_partitioned_sorted", write)
    before = _shuffle_files(spark)
    wh = warehouse(spark, SF)
    want = {tuple(r) for r in wh.fact_fulfillment.collect()}
    before |= _shuffle_files(spark)
    built = pipeline.build_all(spark, warehouse(spark, SF), f"{tmp_dir}/out", with_hourly=False)
    large = sorted(spans[name] for name in pipeline.FACT_ROWS)
    assert all(a[1] <= b[0] for a, b in zip(large, large[1:]))
    assert not _left(spark, before)
    fact = spark.read.parquet(f"{built.out_dir}/core/fact_fulfillment").select(*wh.fact_fulfillment.columns)
    assert {tuple(r) for r in fact.collect()} == want
