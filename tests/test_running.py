import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators.running import running_min_members, running_sum

T0 = dt.datetime(2024, 1, 1)


def _rows(seed, n, hot=0.3):
    rnd = random.Random(seed)
    rows = []
    ids = list(range(n))
    rnd.shuffle(ids)
    for i in ids:
        user = 0 if rnd.random() < hot else rnd.randint(1, 20)
        ts = T0 + dt.timedelta(days=rnd.randint(0, 3), seconds=rnd.randint(0, 5) * 3600)
        rows.append((i, user, ts))
    return rows


def test_running_min_members_equals_window(spark):
    for seed in (1, 2, 3):
        rows = _rows(seed, 400)
        df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp_ntz").repartition(4)
        w = Window.partitionBy("user_id").orderBy("ts")
        want = {r.id for r in df.withColumn("m", F.min("id").over(w)).where("id = m").collect()}
        got = {r.id for r in running_min_members(df, "user_id", "ts", "id").collect()}
        assert got == want


def test_running_min_members_peers_and_later_smaller_ids(spark):
    # ids 10, 5, 7 in time order: 10 and 5 are running minima, 7 is not;
    # 4 shares 5's timestamp (a peer), so the minimum at that time is 4.
    rows = [(10, 1, T0), (5, 1, T0 + dt.timedelta(hours=1)), (4, 1, T0 + dt.timedelta(hours=1)),
            (7, 1, T0 + dt.timedelta(days=2))]
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp_ntz")
    assert {r.id for r in running_min_members(df, "user_id", "ts", "id").collect()} == {10, 4}


def test_running_sum(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 1, 4), (1, 3, 1)], "p int, h int, v int")
    out = sorted(tuple(r) for r in running_sum(df, "p", "h", "v", "c").select("p", "h", "c").collect())
    assert out == [(1, 1, 5), (1, 2, 8), (1, 3, 9), (2, 1, 4)]
