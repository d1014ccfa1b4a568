"""Batch object layout, parquet sinks and the load-side fallback read
(SURVEY SRC4-SRC9, SRC11, SORT1).

Layout: ``{base}/{source}/{table}/ds=YYYY-MM-DD/run=<id>/`` (Hive-style, so a
filter on ``ds`` prunes directories). ``ds`` is the day of the run that wrote the
batch. Writes go through Spark's file committer: a batch directory appears
whole or not at all. Runs never replace each other's batches; a run that is
repeated under its own id replaces its own (dynamic partition overwrite)."""

from __future__ import annotations

import logging
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import yyyymm


def batch_path(base: str, source: str, table: str, ds: str | None = None) -> str:
    """SRC4: where the extract of (source, table) for day ``ds`` lives."""
    root = f"{base.rstrip('/')}/{source}/{table}"
    return root if ds is None else f"{root}/ds={ds}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path (driver-side
    metadata call, no data is read). Without JVM access (Spark Connect) it
    falls back to resolving the path as a data source."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark._jsparkSession.sessionState().newHadoopConf()
    except Exception:  # noqa: BLE001 - Connect client
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception:  # noqa: BLE001 - path not found
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


@dataclass(frozen=True)
class Batch:
    """What one run wrote: rows, and the newest value of the watermark column."""

    rows: int
    newest: object = None


def write_batch(df: DataFrame, base: str, source: str, table: str, ds: str, run: str,
                ts_col: str | None = None) -> Batch:
    """SRC5: write a batch under (ds, run); an empty batch writes no data. Row count
    and newest timestamp are observed during the write, so they are those of
    the rows written and the source is read once."""
    obs = Observation(f"rows_{source}_{table}")
    newest = F.max(ts_col) if ts_col else F.lit(None)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), newest.alias("newest"))
    (observed.withColumns({"ds": F.lit(ds), "run": F.lit(run)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ds", "run").parquet(batch_path(base, source, table)))
    return Batch(int(obs.get["rows"]), obs.get["newest"])


class UnreadableFiles(RuntimeError):
    pass


def probe_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, rows, fault) of every Parquet file under ``root``: each is decoded whole,
    page by page, in the task that reads it. A sound file, an empty one too, has no fault."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(root).select("path", "content"))

    def probe(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                rows, fault = 0, None
                try:
                    file = pq.ParquetFile(pa.BufferReader(content.as_buffer()), page_checksum_verification=True)
                    rows = sum(x.num_rows for x in file.iter_batches())
                    if rows != file.metadata.num_rows:
                        fault = f"{rows} of {file.metadata.num_rows} rows"
                except Exception as e:  # noqa: BLE001 - whatever the decoder says is the fault
                    fault = f"{type(e).__name__}: {e}"[:300]
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([None if fault else rows], pa.int64()),
                                                  pa.array([fault], pa.string())], names=["path", "rows", "fault"])
    return files.mapInArrow(probe, "path string, rows bigint, fault string")


@contextmanager
def _text_partitions(spark: SparkSession):
    """ds and run are text, whatever they look like ('007' is no number)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_batch(spark: SparkSession, base: str, source: str, table: str, ds: str,
               schema=None, skip_unreadable: bool = False) -> DataFrame:
    """SRC6/SRC7: the batches of day ``ds`` if there are any, otherwise every batch
    of the table. The day's read fails on an unreadable file. So does the
    fallback, unless ``skip_unreadable``: then damaged files are left out whole,
    the sound ones are read whole, and a warning names every file left out."""
    root = batch_path(base, source, table)
    reader = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "false").option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    paths = [batch_path(base, source, table, ds)]      # only that day's files are opened; ds and run stay columns
    if not path_exists(spark, paths[0]):
        paths = [root]
        found = probe_files(spark, root)
        bad = {r["path"]: r["fault"] for r in found.where("fault IS NOT NULL").collect()}   # one row per damaged file
        if bad and not skip_unreadable:
            raise UnreadableFiles(f"{len(bad)} unreadable files under {root}: {dict(list(bad.items())[:5])}")
        if bad:
            for path, fault in sorted(bad.items()):
                logging.getLogger(__name__).warning("skipped %s: %s", path, fault)
            paths = [f for f in _files(spark, root) if f not in bad]
            if not paths:
                raise UnreadableFiles(f"none of the {len(bad)} files under {root} is readable")
    with _text_partitions(spark):
        return reader.parquet(*paths)


def _files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the Parquet files under ``root`` (a listing; no file is opened)."""
    return [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(root).select("path").collect()]


# a row's place among all batches of its table; values compare field by field
BATCH_ORDER = "struct<ds:string,run:string,file:string,row:bigint>"


def batch_order() -> Column:
    """SRC9/INC3: of a row that ``read_batch`` or a file stream over the same layout has
    just read: its day, run, file and place in the file."""
    return F.struct(F.col("ds").cast("string").alias("ds"), F.col("run").cast("string").alias("run"),
                    F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def stamp_loaded_at(df: DataFrame) -> DataFrame:
    """SRC9: one load timestamp per load. With the row's ``batch_order`` (column
    load_seq) it is the dedupe version: of the copies that one load brings, that of
    the latest day, run and place wins, whatever the size of the batches. Rows that
    come from no batch are numbered as they come."""
    if "load_seq" not in df.columns:
        none = F.lit(None).cast("string")
        df = df.withColumn("load_seq", F.struct(none.alias("ds"), none.alias("run"), none.alias("file"),
                                                F.monotonically_increasing_id().alias("row")))
    return df.withColumns({"loaded_at": F.current_timestamp().cast("timestamp_ntz"), "load_seq": F.col("load_seq")})


def append(df: DataFrame, path: str, partition_by: list[str] | None = None,
           truncate: bool = False) -> int:
    """SRC8 / MERGE3: append a batch (or replace the table when ``truncate``);
    returns rows written, observed during the write."""
    obs = Observation("rows_appended")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite" if truncate else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def write_partitioned_sorted(df: DataFrame, path: str, date_col: str, sort_cols: list[str],
                             grain: str = "month", replace: str = "table", columns: list[Column] | None = None) -> None:
    """SRC11 + SORT1: partition a model by toYYYYMM(date) (or by day) and sort
    each file by the model's order key, so parquet min/max statistics prune
    row groups on the sort key. The rebalance clusters rows of one partition
    value into few write tasks but lets AQE split a large month into
    advisory-sized tasks (a plain repartition on the month would send a whole
    month to one task). replace="table" rebuilds the model: periods that no
    longer have rows go. replace="periods" replaces only the periods written.
    columns: those of the table, computed from the rows of ``df`` after they were
    moved (default: the columns of ``df``), so that nothing is moved that follows
    from the rest of its row."""
    if replace not in ("table", "periods"):
        raise ValueError(f"replace must be 'table' or 'periods', not {replace!r}")
    key = "yyyymm" if grain == "month" else "yyyymmdd"
    part = yyyymm(date_col) if grain == "month" else F.date_format(date_col, "yyyyMMdd").cast("int")
    out = df.withColumn(key, part).hint("rebalance", key)
    if columns is not None:
        out = out.select(*columns, key)
    (out.sortWithinPartitions(key, *sort_cols)
        .write.mode("overwrite").option("compression", "zstd")
        .option("partitionOverwriteMode", "static" if replace == "table" else "dynamic")
        .partitionBy(key).parquet(path))


def filter_period(df: DataFrame, date_col: str, start: str, end: str,
                  part_col: str = "yyyymm") -> DataFrame:
    """Date-range filter on a month-partitioned table that also constrains the
    partition column, so directory pruning happens (Spark does not derive the
    partition predicate from the date predicate)."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where((F.col(date_col) >= s) & (F.col(date_col) <= e) &
                    (F.col(part_col) >= yyyymm(s)) & (F.col(part_col) <= yyyymm(e)))
