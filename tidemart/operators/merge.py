"""Upsert, insert-if-absent and back-fill operators (SURVEY MERGE1, MERGE2,
DML1, JOIN9) over plain DataFrames.

Without a table format these return the new table state; the caller writes
it to a new location (or partition) and swaps, which is the atomic unit on
a file store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import written_once


def _key_match(keys: Sequence[str], a: str, b: str):
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def last_update(updates: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the last by ``order_col`` (of equal ones, the greatest row)."""
    others = [c for c in updates.columns if c not in keys]
    return (updates.groupBy(*keys)
            .agg(F.max(F.struct(F.col(order_col).alias("__order"), *[F.col(c) for c in others])).alias("__u"))
            .select(*keys, *[F.col(f"__u.{c}").alias(c) for c in others]))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], order_col: str) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c for c in
    update_cols. Matched rows take ``update_cols`` from ``updates`` (NULLs
    included) and keep every other column; new keys are inserted whole;
    untouched target rows pass through. The batch is always reduced to one
    update of a key, the last by ``order_col`` (of equal ones, the greatest
    row), as if its rows were applied one by one."""
    keys, update_cols = list(keys), list(update_cols)
    updates = last_update(updates, keys, order_col)
    t = target.alias("t").withColumn("__t", F.lit(True))
    u = updates.alias("u").withColumn("__u", F.lit(True))
    j = t.join(u, _key_match(keys, "t", "u"), "full_outer")
    in_u = F.col("__u").isNotNull()
    in_t = F.col("__t").isNotNull()
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"u.{c}")).alias(c))
        elif c in update_cols:
            cols.append(F.when(in_u, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
    return j.select(*cols)


def dense_index(df: DataFrame, order_cols: Sequence[str], start: int = 0,
                num_partitions: int | None = None, out: str = "row_index") -> DataFrame:
    """Adds ``out`` = start + 0-based rank of each row in ``order_cols``
    order (a distributed zipWithIndex): range-partition and sort on the order,
    number the rows within each partition, and add the counts of the partitions
    before (one row per partition). The ranged rows are written once to the
    shared folder and everything is derived from that: a second evaluation of
    the sampled ranges could number rows differently. ``order_cols`` should be
    unique."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition above bit 33 and the row's place within it below
    ranged = written_once(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                          .withColumn("__at", F.monotonically_increasing_id()), "dense-index")
    r = ranged.withColumn("__pid", F.shiftright("__at", 33))
    counts = r.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select("__pid", (F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (r.join(offs, "__pid", "left")
             .withColumn(out, F.lit(start) + F.coalesce("__off", F.lit(0)) + place)
             .drop("__pid", "__at", "__off"))


@dataclass(frozen=True)
class IdMapping:
    """``values``: the input rows with their ``id``; ``created``: the rows to insert into
    the target, so that a later call finds the same ids."""

    values: DataFrame
    created: DataFrame


def get_or_create_ids(values: DataFrame, value_col: str, target: DataFrame, target_value: str,
                      target_id: str) -> IdMapping:
    """MERGE2: map each input row's ``value_col`` to an id from ``target``;
    values missing there get new ids max(id)+1, max(id)+2, ... in value order."""
    existing = target.groupBy(F.col(target_value).alias("__v")).agg(F.min(target_id).alias("id"))
    distinct = values.select(F.col(value_col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    new = distinct.join(existing, "__v", "left_anti")
    top = target.agg(F.coalesce(F.max(target_id), F.lit(0)).alias("m")).first()["m"]
    created = (dense_index(new, ["__v"], start=int(top) + 1, out="id")
               .select("__v", F.col("id").cast(existing.schema["id"].dataType)))
    mapping = existing.unionByName(created)
    return IdMapping(values.join(mapping.withColumnRenamed("__v", value_col), value_col, "left"),
                     created.select(F.col("id").alias(target_id), F.col("__v").alias(target_value)))


def backfill_cost(items: DataFrame, products: DataFrame, cost_col: str = "cost_price",
                  price_col: str = "price_at_time", product_key: str = "product_id",
                  product_id: str = "id", product_cost: str = "cost_price",
                  fallback_ratio: float = 0.5) -> DataFrame:
    """DML1 (update-from join, then a second update): a missing or
    non-positive cost takes the product's cost when the product exists, and
    if it is still missing or non-positive, price * ``fallback_ratio``."""
    p = products.select(F.col(product_id).alias("__pid"), F.col(product_cost).alias("__pcost"))
    j = items.join(p, F.col(product_key) == F.col("__pid"), "left")
    bad = lambda c: c.isNull() | (c <= 0)
    step1 = F.when(bad(F.col(cost_col)) & F.col("__pid").isNotNull(), F.col("__pcost")) \
             .otherwise(F.col(cost_col))
    step2 = F.when(bad(step1), F.col(price_col) * fallback_ratio).otherwise(step1)
    return j.select(*[step2.alias(c) if c == cost_col else F.col(c) for c in items.columns])


def add_column(df: DataFrame, name: str, expr, not_null: bool = False,
               check: str | None = None) -> DataFrame:
    """DML2: ADD COLUMN (+ optional SET NOT NULL / CHECK), enforced on the
    data in one aggregate pass before the DataFrame is returned."""
    from tidemart.operators.quality import enforce, expect
    from tidemart.operators.quality import not_null as nn
    out = df.withColumn(name, expr)
    checks = ([nn(name)] if not_null else []) + ([expect(f"{name}_check", check)] if check else [])
    return enforce(out, checks) if checks else out


def take_any(df: DataFrame, n: int) -> DataFrame:
    """LIM1: n rows without an order (which rows is unspecified)."""
    return df.limit(n)
