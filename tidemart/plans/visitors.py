"""Unique visitors by day, week and month from mergeable sketches (AGG3, AGG4).

Daily unique counts cannot be added up: a visitor of two days is one of the
week. A day is therefore stored with a HyperLogLog sketch of its visitors (a
few kilobytes whatever the traffic), and a week or a month is the union of its
days' sketches: neither reads the sessions again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.plans.warehouse import Warehouse

LG_K = 14               # 2^14 registers: a standard error of 0.8 %
PERIODS = ("day", "week", "month")


def daily_sketches(wh: Warehouse) -> DataFrame:
    """(session_date, sessions, visitors): ``visitors`` is the sketch of the day's customers."""
    return wh.fact_sessions.groupBy("session_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.hll_sketch_agg("customer_sk", F.lit(LG_K)).alias("visitors"))


def by_period(daily: DataFrame) -> DataFrame:
    """(period, period_start, sessions, visitors) for each of PERIODS, visitors estimated from
    the united sketches. A day's row goes to three groups; no session is read."""
    rows = daily.withColumn("period", F.explode(F.array(*map(F.lit, PERIODS))))
    start = F.to_date(F.when(F.col("period") == "day", F.col("session_date"))
                      .when(F.col("period") == "week", F.date_trunc("week", "session_date"))
                      .otherwise(F.date_trunc("month", "session_date")))
    return rows.groupBy("period", start.alias("period_start")).agg(
        F.sum("sessions").alias("sessions"), F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors"))


def exact(wh: Warehouse) -> DataFrame:
    """(period, period_start, exact_visitors) from the sessions."""
    s = wh.fact_sessions.select("customer_sk", "session_date")
    rows = s.select("customer_sk", F.explode(F.array(*[
        F.struct(F.lit(p).alias("period"), F.to_date(F.date_trunc(p, "session_date")).alias("period_start"))
        for p in PERIODS])).alias("p"))
    return rows.groupBy("p.period", "p.period_start").agg(F.countDistinct("customer_sk").alias("exact_visitors"))
