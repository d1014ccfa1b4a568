"""Spark session settings shared by tests, the bench and the query registry."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects. ANSI mode stays on (Spark 4
# default): unguarded division by zero raises, so every ratio is guarded.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemart") -> SparkSession:
    """Local/test session. On a cluster, the submitting environment supplies
    master, memory and spark.checkpoint.dir; we only add the SQL settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TIDEMART_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Runtime SQL settings (safe to apply to a session we did not create)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


# Most that a task of the warehouse models gets: of a file, and of a shuffle. A task sorts
# its rows before each aggregate over row structs, so what it holds follows these sizes.
TASK_INPUT = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}
_UNITS = {"": 1, "b": 1, **{u + end: 1 << 10 * k for k, u in enumerate("kmgtp", 1) for end in ("", "b")}}


def bound_task_input(spark: SparkSession) -> None:
    """Lowers the session's sizes of TASK_INPUT to those; smaller ones are kept."""
    for k, most in TASK_INPUT.items():
        number, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(k).lower()).groups()
        if int(number) * _UNITS[unit] > most:
            spark.conf.set(k, str(most))


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, what a query shuffled is deleted from the executors' disks when it ends,
    not when the driver next collects garbage. For queries that run once, such as
    writes: one that runs again shuffles again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only a local session without that setting gets one of its own: elsewhere a
    folder of one machine would be out of the other executors' reach."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    sc = _spark_context(spark)
    if not cur and sc is not None:
        cur = sc.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="tidemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc is not None:
        sc.setCheckpointDir(cur)
    return cur


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: rows that must be the same
    however often, and by whichever executor, they are read."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tidemart/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spark_context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None
