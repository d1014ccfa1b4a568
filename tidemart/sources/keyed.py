"""Tables with one row per key, kept up to date batch by batch (SNAP1, WIN3, MERGE1).

A raw table only grows, and a latest-version read of it groups all its history.
``KeyedTable`` keeps the answer instead: a table partitioned by a hash of the
key (``part``), bucketed and sorted by the key within a partition. A batch is
reduced to one row per key, joined by sort-merge to the partitions it touches and
replaces just those:

  * the touched partitions reach the scan by dynamic partition pruning, so
    the others are neither read nor written and keep their files;
  * the kept side is bucketed by the join key, so only the batch is shuffled;
  * a reader scans the table: no grouping, no exchange.

A partition is replaced whole when the write commits. A merge that fails in
between is repeated: merging a batch twice gives what merging it once does."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.merge import last_update
from tidemart.operators.running import running_min_steps
from tidemart.operators.snapshot import SEQUENCE
from tidemart.session import apply_sql_conf, written_once
from tidemart.sources.batch_io import BATCH_ORDER, path_exists
from tidemart.sources.catalog import RawTable

PARTS = 16      # partitions of a table; thousands for one of 100 TB
BUCKETS = 8     # buckets in each


class NullKeys(ValueError):
    pass


class KeyedTable:
    """``ddl``: the columns, keys included. Opens what is under ``path``, or starts it."""

    def __init__(self, spark: SparkSession, path: str, ddl: str, keys: Sequence[str], parts: int = PARTS,
                 buckets: int = BUCKETS, name: str | None = None, part_by: Sequence[str] | None = None):
        apply_sql_conf(spark)       # partitions are overwritten one by one
        self.spark, self.path, self.keys, self.parts = spark, path, list(keys), parts
        self.part_by = list(part_by or keys)        # rows that are kept together
        self.name = name or f"keyed_{uuid.uuid4().hex}"
        known = path_exists(spark, path)
        on = ", ".join(self.keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({ddl}, part int) USING parquet PARTITIONED BY (part) "
                  f"CLUSTERED BY ({on}) SORTED BY ({on}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if known:
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    @property
    def _table(self) -> DataFrame:
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self._table.drop("part")

    def forget(self) -> None:
        """Takes the name out of the session's catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _with_part(self, df: DataFrame) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64(*self.part_by), F.lit(self.parts)).cast("int"))

    def touched(self, batch: DataFrame) -> DataFrame:
        """The kept rows of the partitions that ``batch`` (with part) has rows for."""
        parts = batch.select("part").where("part >= 0").distinct()      # at most ``self.parts`` rows
        return self._table.join(F.broadcast(parts), "part", "left_semi")

    def combined(self, batch: DataFrame, column: Callable[[str, Column, Column], Column]) -> DataFrame:
        """The touched partitions with ``batch`` (one row per key, with part) in them;
        ``column(name, in_old, in_new)`` says which value a column takes."""
        old = self.touched(batch).withColumn("__old", F.lit(True)).alias("o").hint("merge")
        new = batch.withColumn("__new", F.lit(True)).alias("n").hint("merge")
        on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in self.keys])
        in_old, in_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
        cols = [F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in [*self.keys, "part"] else column(c, in_old, in_new)
                for c in self._table.columns]
        return old.join(new, on, "full_outer").select(*[x.alias(c) for x, c in zip(cols, self._table.columns, strict=True)])

    def _replace(self, batch: DataFrame, column: Callable[[str, Column, Column], Column]) -> None:
        """``batch`` has one row per key; it is written once, so that both of its uses see the same rows."""
        batch = written_once(self._with_part(batch), "keyed-batch")
        if not batch.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])).isEmpty():
            raise NullKeys(f"rows of the batch have no {self.keys}")
        self.combined(batch, column).write.insertInto(self.name, overwrite=True)

    def rebuild(self, batch: DataFrame, new_rows: Callable[[DataFrame], DataFrame]) -> None:
        """Replaces the partitions that ``batch`` touches by ``new_rows`` of what they hold and
        the batch; no partition may end up empty."""
        names = [c for c in self._table.columns if c != "part"]
        batch = written_once(self._with_part(batch.select(*names)), "keyed-batch")
        rows = new_rows(self.touched(batch).select(*names).unionByName(batch.select(*names)))
        self._with_part(rows.select(*names)).write.insertInto(self.name, overwrite=True)

    def merge(self, batch: DataFrame, version: Sequence[str] = ("loaded_at", SEQUENCE)) -> None:
        """Rows of ``batch`` (all columns, any number per key) whose version is at least
        that of the kept row take its place; new keys are added."""
        names = [c for c in self._table.columns if c != "part"]
        order = lambda side: F.struct(*[F.col(f"{side}.{v}") for v in version])     # noqa: E731
        batch = batch.select(*names)
        one = batch.groupBy(*self.keys).agg(F.max(F.struct(*[F.col(v).alias(f"v{k}") for k, v in enumerate(version)], *[
            F.col(c) for c in names if c not in self.keys])).alias("__row"))
        one = one.select(*[F.col(c) if c in self.keys else F.col(f"__row.{c}").alias(c) for c in names])
        self._replace(one, lambda c, old, new: F.when(new & (~old | (order("n") >= order("o"))), F.col(f"n.{c}"))
                      .otherwise(F.col(f"o.{c}")))

    def upsert(self, updates: DataFrame, update_cols: Sequence[str], order_col: str) -> None:
        """MERGE1 in place: as ``operators.merge.upsert``, but only the partitions that
        ``updates`` touch are read and written."""
        def column(c: str, old: Column, new: Column) -> Column:
            if c in update_cols:
                return F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
            return F.when(old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        names = [c for c in self._table.columns if c != "part"]
        self._replace(last_update(updates, self.keys, order_col).select(*names), column)


class LatestState:
    """The latest version of every row of a raw table: what ``latest`` over the whole raw
    table gives, kept, with only the loads since the last refresh merged into it."""

    def __init__(self, spark: SparkSession, state_dir: str, table: RawTable, **sizes: int):
        self.table = table
        self.kept = KeyedTable(spark, f"{state_dir.rstrip('/')}/{table.name}",
                               f"{table.ddl}, loaded_at timestamp_ntz, {SEQUENCE} {BATCH_ORDER}", table.keys, **sizes)

    def since(self, raw: DataFrame) -> DataFrame:
        """The rows of ``raw`` that the state may lack. The newest load in the state is read
        again, as a merge that broke off may hold part of it; a load's files have one
        load time, so the footers keep the scan off older ones."""
        newest = self.kept.read().agg(F.max("loaded_at").alias("at")).first()["at"]     # one value
        return raw if newest is None else raw.where(F.col("loaded_at") >= F.lit(newest).cast("timestamp_ntz"))

    def refresh(self, raw: DataFrame) -> None:
        new = self.since(raw)
        if not new.isEmpty():
            self.kept.merge(new)

    def read(self, columns: Sequence[str] | None = None) -> DataFrame:
        """One row per key; as ``latest``, without the place in the load."""
        df = self.kept.read().drop(SEQUENCE)
        return df if columns is None else df.select(*dict.fromkeys([*self.table.keys, *columns]))


class FirstOrders:
    """WIN1 kept: the orders that were their customer's first so far, by running minimum of
    the order id. Kept are the steps of that minimum, partitioned by customer; a new
    load is joined by the steps of the customers' partitions it touches, also when its
    orders are older than those loaded before: they take the flag from later ones."""

    def __init__(self, spark: SparkSession, path: str, **sizes: int):
        self.kept = KeyedTable(spark, path, "user_id long, order_ts timestamp_ntz, order_id long",
                               ["user_id", "order_ts"], part_by=["user_id"], **sizes)

    def add(self, orders: DataFrame) -> None:
        """``orders``: user_id, order_ts, order_id; those that were added before may come again."""
        self.kept.rebuild(orders, lambda rows: running_min_steps(rows, "user_id", "order_ts", "order_id"))

    def flagged(self) -> DataFrame:
        return self.kept.read().select("order_id")

