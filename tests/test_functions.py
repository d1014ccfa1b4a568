import datetime as dt

import duckdb

from tidemart.functions.dates import (day_of_week_mon1, hours_crossed, seconds_between,
                                      week_of_year_sunday)
from tidemart.functions.kpi import ratio, ratio_pct, rnd, safe_div


def test_week_of_year_sunday_matches_strftime_U(spark):
    # three calendar years, as the reference's spine covers
    days = [(dt.date(2023, 1, 1) + dt.timedelta(days=i),) for i in range(1095)]
    df = spark.createDataFrame(days, "d date")
    got = {r.d: r.w for r in df.select("d", week_of_year_sunday("d").alias("w")).collect()}
    con = duckdb.connect()
    want = dict(con.execute(
        "SELECT d::DATE, CAST(strftime(d, '%U') AS INTEGER) FROM "
        "generate_series(TIMESTAMP '2023-01-01', TIMESTAMP '2025-12-30', INTERVAL 1 DAY) t(d)").fetchall())
    assert got == want


def test_day_of_week_monday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r[0] for r in df.select(day_of_week_mon1("d")).collect()] == [1, 7]


def test_hours_crossed_counts_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1)),
            (dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 59)),
            (dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 1, 1, 23, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(hours_crossed("a", "b").alias("h"), seconds_between("a", "b").alias("s")).collect()
    assert [r.h for r in out] == [1, 0, -1]
    assert [r.s for r in out] == [120, 3540, -3600]


def test_guarded_ratios_and_rounding(spark):
    df = spark.createDataFrame([(1, 0, 2.175), (1, 8, 0.145), (3, 32, -2.175)], "n int, d int, x double")
    out = df.select(ratio_pct("n", "d").alias("p"), safe_div("n", "d").alias("q"),
                    ratio("n", "d", 3).alias("r"), rnd("x", 2).alias("x2")).collect()
    assert [r.p for r in out] == [0.0, 12.5, 9.38]
    assert [r.q for r in out] == [0.0, 0.125, 0.09375]
    assert [r.r for r in out] == [0.0, 0.125, 0.094]
    # half away from zero on the decimal form, whatever the binary value
    assert [r.x2 for r in out] == [2.18, 0.15, -2.18]
