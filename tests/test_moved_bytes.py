"""What the model build moves: lines once for the sales marts and with numbers for names, facts without
the columns that follow from others, staged rows with the tested columns only."""
import datetime as dt
import random
import re
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.plans import checks
from tidemart.plans.marts import order_customer_rollup, product_groups
from tidemart.plans.registry import warehouse
from tidemart.sources.batch_io import write_partitioned_sorted

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def _lines(spark, seed=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(300):
        order = rnd.randint(1, 60)
        rows.append((DAY + dt.timedelta(days=order % 3), rnd.choice([1, 2, 3, 4, 5, 9]), order % 20, order,
                     Decimal(rnd.randint(1, 999)) / 100, None if rnd.random() < .1 else Decimal("0.50"), rnd.randint(1, 4), order % 2))
    return rows, spark.createDataFrame(rows, "day date, product_sk long, customer_sk long, order_id long, revenue decimal(18,2), "
                                             "cogs decimal(18,2), quantity int, is_first_order int").withColumn(
        "gross_profit", F.col("revenue") - F.col("cogs"))


def _products(spark):
    return spark.createDataFrame([(1, "c", "x"), (2, "c", "x"), (3, None, "x"), (4, None, "x"), (5, "d", None), (None, "d", None),
                                  (None, "e", "y")], "product_sk long, category string, name string")


def test_rollup_by_group_is_exact_and_shuffles_lines_once(spark):
    rows, lines = _lines(spark)
    of, groups = product_groups(_products(spark), ["category", "name"])
    assert sorted(map(tuple, of.collect())) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 5)]
    assert sorted(map(tuple, groups.select("product_group", "category", "name").collect())) == [
        (1, "c", "x"), (3, None, "x"), (5, "d", None)]
    group_of = {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    want = defaultdict(list)
    for r in rows:
        if r[1] in group_of:
            want[(r[0], group_of[r[1]])].append(r)
    out = order_customer_rollup(lines.join(of, "product_sk"), ["day", "product_group"], extra_first=True)
    got = {(r.day, r.product_group): r for r in out.collect()}
    assert set(got) == set(want)
    for k, ls in want.items():
        g = got[k]
        both = [x[4] - x[5] for x in ls if x[5] is not None]
        assert (g.rev, g.gp, g.total_units) == (sum(x[4] for x in ls), sum(both) if both else None, sum(x[6] for x in ls))
        assert (g.total_orders, g.unique_customers, g.new_customers) == (
            len({x[3] for x in ls}), len({x[2] for x in ls}), len({x[2] for x in ls if x[7] == 1}))
    plan = order_customer_rollup(lines, ["day", "product_sk"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_columns_are_computed_behind_the_shuffle(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 6)), (3, None)], "id int, ts timestamp_ntz")
    write_partitioned_sorted(df, f"{tmp_dir}/t", "ts", ["id"], columns=[F.col("id"), F.to_date("ts").alias("day")])
    got = spark.read.parquet(f"{tmp_dir}/t")
    assert sorted(map(tuple, got.select("id", "day", "yyyymm").collect())) == [
        (1, dt.date(2024, 1, 5), 202401), (2, dt.date(2024, 2, 6), 202402), (3, None, None)]


def test_staged_models_are_read_with_the_tested_columns(spark):
    wh = warehouse(spark, SF)
    frames = {m: df for m, df in checks.model_frames(wh, spark.range(1)).items() if m.startswith("stg_")}
    for m, df in frames.items():
        assert set(df.columns) == {col for model, col, *_ in checks.MODEL_TESTS if model == m}, m
