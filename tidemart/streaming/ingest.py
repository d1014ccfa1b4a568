"""Streaming form of the hourly load.

Extract batches land as ``{base}/{source}/{table}/ds=YYYY-MM-DD/run=<id>/`` parquet
files; a file stream over the table root picks up new batch files, and each
micro-batch is type-repaired, stamped with ``loaded_at`` and the batches' order
(day, run, place in the file) and appended to the raw table. Replayed or overlapping batches only add copies that the
latest-version read resolves, so the load is effectively exactly-once for
readers. Trigger.AvailableNow processes what is there and stops, which is
how a scheduled (hourly) run uses it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.coerce import coerce_to_contract
from tidemart.operators.snapshot import latest
from tidemart.sources.batch_io import batch_order, stamp_loaded_at
from tidemart.sources.catalog import RawTable


def stream_load(spark: SparkSession, batch_root: str, table: RawTable, raw_path: str,
                checkpoint: str, max_files_per_trigger: int = 16) -> None:
    schema = T.StructType([*table.schema.fields, T.StructField("ds", T.StringType()),
                           T.StructField("run", T.StringType())])
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(batch_root).select(*table.column_names, "ds", batch_order().alias("load_seq")))

    def load(batch: DataFrame, epoch_id: int) -> None:
        (stamp_loaded_at(coerce_to_contract(batch, table.schema))
         .withColumn("load_batch", F.lit(epoch_id).cast("long"))
         .write.mode("append").parquet(raw_path))

    q = (src.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, raw_path: str, keys: list[str]) -> DataFrame:
    """The raw table as of now: latest version per key (load time, micro-batch, then
    the order of the batches within it)."""
    raw = spark.read.parquet(raw_path)
    cols = [c for c in raw.columns if c not in ("loaded_at", "load_batch", "load_seq")]
    out = latest(raw, keys, "loaded_at", tiebreak=["load_batch", "load_seq"], columns=cols)
    return out.select(*cols)
