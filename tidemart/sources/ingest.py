"""Incremental extract and high-water marks (SURVEY SRC1-SRC3, INC1-INC3,
AGG11, AGG12, F21).

Semantics kept from the reference: the watermark is a day ('YYYY-MM-DD'),
the extract predicate is strict (ts > watermark), and the next watermark is
the day of the batch's max timestamp. Every run therefore re-reads the whole
newest day; the duplicates this causes are absorbed by the latest-version
read. Rows that arrive with a timestamp older than the watermark day are
missed; ``lookback_days`` widens the window to pick them up. The batch itself is
filed under the day of the run, where the load of that day looks for it."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.coerce import coerce_to_contract, strip_timezone
from tidemart.sources.batch_io import (BATCH_ORDER, append, batch_order, batch_path, path_exists, read_batch, stamp_loaded_at,
                                       write_batch)
from tidemart.sources.catalog import RAW_TABLES, RawTable

DEFAULT_INIT_DATE = "2020-01-01"
CONTROL_SCHEMA = "table_name string, max_date date, updated_at timestamp_ntz"


def extract_incremental(df: DataFrame, ts_col: str, watermark: str,
                        lookback_days: int = 0) -> DataFrame:
    """SRC2: rows with ``ts_col`` > watermark (minus ``lookback_days``). The
    predicate is a plain comparison, so it reaches the parquet/JDBC scan."""
    wm = F.lit(watermark).cast("timestamp_ntz")
    if lookback_days:
        wm = F.lit(watermark).cast("date") - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
        wm = wm.cast("timestamp_ntz")
    return df.where(F.col(ts_col) > wm)


def jdbc_reader(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
                properties: dict | None = None) -> DataFrame:
    """SRC1: full read of a source table over JDBC, split into parallel range
    reads on a numeric column when one is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def next_watermark(batch: DataFrame, ts_col: str, current: str) -> DataFrame:
    """AGG11 + AGG12 + F21: one row: the day of max(ts), or ``current`` when
    the batch is empty."""
    return batch.agg(F.coalesce(F.date_format(F.max(ts_col), "yyyy-MM-dd"), F.lit(current))
                     .alias("max_date"))


@dataclass
class Watermarks:
    """INC1/INC2: the control table of high-water marks, stored as parquet
    partitioned by table name so updating one table rewrites only its own
    partition (no read-modify-write of the whole control table)."""

    spark: SparkSession
    path: str

    def table(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.range(0).select(
                F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("date").alias("max_date"),
                F.lit(None).cast("timestamp_ntz").alias("updated_at"))
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(self.path)

    def get(self, table_name: str, init_date: str = DEFAULT_INIT_DATE) -> str:
        """COALESCE(MAX(max_date), init) for one table; a single scalar."""
        row = (self.table().where(F.col("table_name") == table_name)
               .agg(F.coalesce(F.date_format(F.max("max_date"), "yyyy-MM-dd"),
                               F.lit(init_date)).alias("d")).first())
        return row["d"]

    def update(self, table_name: str, new_date: str) -> None:
        """Upsert (table_name -> max_date, updated_at = now)."""
        out = self.spark.range(1).select(
            F.lit(table_name).alias("table_name"), F.lit(new_date).cast("date").alias("max_date"),
            F.current_timestamp().cast("timestamp_ntz").alias("updated_at"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("table_name").parquet(self.path))


def naive_timestamps(df: DataFrame) -> DataFrame:
    """every zoned timestamp column as its UTC wall clock."""
    return df.select(*[strip_timezone(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def new_run_id() -> str:
    """Ids of later runs sort after those of earlier ones."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def extract_source(spark: SparkSession, source: str, read_table, base: str,
                   marks: Watermarks, init_date: str = DEFAULT_INIT_DATE,
                   tables: list[RawTable] | None = None, lookback_days: int = 0,
                   run_date: str | None = None, run: str | None = None) -> dict:
    """SRC3: for each catalogued table of ``source``: watermark -> incremental
    read -> batch under ds=<run date>/run=<id> -> watermark to the day of the
    newest row written. Zoned timestamps become naive (F20). The data is
    written before the watermark moves, so a failure between the two only
    causes a re-read (absorbed by the latest-version read); a batch without
    rows leaves the mark. Returns {table: rows written}."""
    out = {}
    run_date = run_date or dt.datetime.now(dt.UTC).date().isoformat()
    run = run or new_run_id()
    for t in tables or [t for t in RAW_TABLES if t.source == source]:
        wm = marks.get(f"{t.source}.{t.table}", init_date)
        batch = extract_incremental(naive_timestamps(read_table(t)), t.ts_col, wm, lookback_days)
        written = write_batch(batch, base, t.source, t.table, run_date, run, t.ts_col)
        out[t.name] = written.rows
        if written.rows:
            marks.update(f"{t.source}.{t.table}", str(written.newest)[:10])
    return out


def load_raw(batch: DataFrame, raw_path: str, table: RawTable | None = None, truncate: bool = False) -> int:
    """Load step: type repair by the table's contract, loaded_at stamp, append to the
    raw table (``truncate`` replaces it, for full reloads)."""
    if table is not None:
        batch = coerce_to_contract(batch, table.schema)
    return append(stamp_loaded_at(batch), raw_path, truncate=truncate)


def load_batches(spark: SparkSession, base: str, raw_dir: str, table: RawTable, ds: str,
                 skip_unreadable: bool = False) -> int:
    """The load of one table: the batches of day ``ds``, or all of them when that day
    has none, appended with their order. A table without any batch is left alone."""
    if not path_exists(spark, batch_path(base, table.source, table.table)):
        return 0
    batch = read_batch(spark, base, table.source, table.table, ds, skip_unreadable=skip_unreadable)
    rows = batch.select(*table.column_names, batch_order().alias("load_seq"))
    return load_raw(rows, f"{raw_dir.rstrip('/')}/{table.name}", table)


def read_raw(spark: SparkSession, raw_dir: str, table: RawTable) -> DataFrame:
    """A raw table by its contract; without rows when nothing was loaded yet."""
    schema = T.StructType([*table.schema.fields, T.StructField("loaded_at", T.TimestampNTZType()),
                           *T.StructType.fromDDL(f"load_seq {BATCH_ORDER}").fields])
    path = f"{raw_dir.rstrip('/')}/{table.name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
