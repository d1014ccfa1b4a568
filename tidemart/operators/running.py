"""Skew-safe running (prefix) window operators.

``Window.partitionBy(user)`` sends every row of a user to one task; with a
user that owns a third of all orders that task would hold a third of the
table. The operators here first reduce rows to (key, timestamp) groups,
then scan per (key, day) and carry the minimum of earlier days in from a
per-(key, day) table. Every window therefore holds at most one day of
second-resolution timestamps (86,400 rows) or one row per calendar day,
independent of data volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_min_members(df: DataFrame, partition: str, order_ts: str, value: str) -> DataFrame:
    """The distinct ``value``s of ``running_min_steps``, one column. Joining it back on
    ``value`` avoids re-shuffling the input by (partition, order_ts)."""
    return running_min_steps(df, partition, order_ts, value).select(value)


def running_min_steps(df: DataFrame, partition: str, order_ts: str, value: str) -> DataFrame:
    """(partition, order_ts, value) of the rows whose ``value`` equals the running
    minimum at their own (partition, order_ts): ``value == min(value) OVER
    (PARTITION BY partition ORDER BY order_ts)`` with SQL's default frame, in which
    rows of equal timestamps are peers. ``order_ts`` should be at second resolution.

    Only the minimum of each (partition, order_ts) group can qualify, so there is at
    most one row per group. The steps of a union are the steps of its parts' steps:
    a row that is no step has an earlier, smaller one before it, and keeps it."""
    per_ts = (df.groupBy(partition, F.to_date(order_ts).alias("__day"), order_ts)
                .agg(F.min(value).alias("__m")))
    per_day = per_ts.groupBy(partition, "__day").agg(F.min("__m").alias("__dm"))
    w_days = (Window.partitionBy(partition).orderBy("__day")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_day.select(partition, "__day", F.min("__dm").over(w_days).alias("__carry"))
    w_in_day = (Window.partitionBy(partition, "__day").orderBy(order_ts)
                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    run = (per_ts.withColumn("__pm", F.min("__m").over(w_in_day))
                 .join(carry, [partition, "__day"], "left")
                 .where(F.col("__m") == F.least("__pm", "__carry")))
    return run.select(partition, order_ts, F.col("__m").alias(value))


def running_sum(df: DataFrame, partition: str, order_col: str, value: str,
                out: str) -> DataFrame:
    """Cumulative sum of ``value`` per ``partition`` ordered by ``order_col``
    (ROWS UNBOUNDED PRECEDING .. CURRENT ROW). Intended for inputs already
    reduced to one row per (partition, hour), i.e. bounded by the calendar."""
    w = (Window.partitionBy(partition).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value).over(w))
