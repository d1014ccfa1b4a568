"""Event streams with bounded state: sessions, duplicates, latest rows.

All three read a directory of files as a stream and free their state behind an
event-time watermark.

``session_windows`` groups a user's events into sessions: one ends when no
event follows within the gap (an event exactly the gap later still belongs). Sessions come out once, when the watermark has
passed their end. What arrives behind the watermark is dropped by the engine;
``SessionRun.late`` says how many events that were. A bounded replay is closed by
two markers far in the future, the first to move the watermark, the second to
start the micro-batch that sees it, so that the last sessions come out as well;
a running job needs none.

``unique_events`` drops repeats of a key within the watermark, as extracts that
read the newest day again send them; a key's state is freed when the watermark
has passed its event by the delay.

``stream_latest`` merges each micro-batch into a kept table: the streaming form
of the latest-version read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.coerce import coerce_to_contract
from tidemart.sources.batch_io import batch_order, stamp_loaded_at
from tidemart.sources.keyed import LatestState
from tidemart.streaming.hourly import EVENTS_SCHEMA

MARKER = "end of replay"        # event type of the marker; it belongs to no user
GAP = "30 minutes"


def _events(spark: SparkSession, path: str, schema: str, files: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _timed(stream: DataFrame, ts_col: str, delay: str) -> DataFrame:
    """withWatermark needs TIMESTAMP: with the session time zone at UTC the cast keeps the wall clock."""
    return stream.withColumn("__ets", F.col(ts_col).cast("timestamp")).withWatermark("__ets", delay)


def add_marker(spark: SparkSession, path: str, schema: str = EVENTS_SCHEMA, part: str = "day=9999-12-31") -> None:
    """Adds a marker to a folder of ``replay_files``, a year after all that is there."""
    there = spark.read.schema(schema).parquet(path)
    there = there.select(*[n for n in T.StructType.fromDDL(schema).fieldNames()])
    known = {"ts": F.max("ts") + F.expr("INTERVAL 365 DAYS"), "event_type": F.lit(MARKER)}
    (there.agg(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in there.schema.fields])
     .coalesce(1).write.mode("append").parquet(f"{path}/{part}"))


def session_windows(stream: DataFrame, key: str, ts_col: str = "ts", value_col: str = "value", gap: str = GAP,
                    delay: str = "1 hour") -> DataFrame:
    """(key, session_start, session_end, events, value_sum); a session ends ``gap`` after its last event."""
    return (_timed(stream, ts_col, delay)
            .groupBy(F.session_window("__ets", gap).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(value_col).cast("decimal(18,2)")).alias("v"),
                 F.max(F.col("event_type") == MARKER).alias("marker"))
            .where("NOT coalesce(marker, false)")      # only here: below the watermark it would hide the marker
            .select(key, F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("session_end"), "events",
                    F.col("v").cast("double").alias("value_sum")))


def _appender(out_path: str):
    """Each micro-batch in a folder of its own: one that is replayed replaces itself."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")
    return write


def _run(query) -> StreamingQuery:
    q = query.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state held after each micro-batch."""
    return [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]


@dataclass(frozen=True)
class SessionRun:
    sessions: DataFrame
    late: int | None        # events behind the watermark, in no session; known when the replay is closed
    state: list[int]


def run_sessions(spark: SparkSession, source_path: str, out_path: str, checkpoint: str, key: str = "user_id",
                 gap: str = GAP, delay: str = "1 hour", files: int = 4, schema: str = EVENTS_SCHEMA,
                 close: bool = False) -> SessionRun:
    """Processes what is under ``source_path``. With ``close`` the replay ends here: all
    sessions come out, and what is in none was late."""
    stream = _events(spark, source_path, schema, files)
    state = []
    for turn in range(3 if close else 1):
        if turn:
            add_marker(spark, source_path, schema)
        q = _run(session_windows(stream, key, gap=gap, delay=delay).writeStream.outputMode("append")
                 .foreachBatch(_appender(out_path)).option("checkpointLocation", checkpoint))
        state += state_rows(q)
    cols = f"{key} {stream.schema[key].dataType.simpleString()}, session_start timestamp_ntz, session_end timestamp_ntz, " \
           "events bigint, value_sum double"
    sessions = spark.read.schema(cols).parquet(f"{out_path}/epoch=*")
    seen = spark.read.schema(schema).parquet(source_path).where(~F.col("event_type").eqNullSafe(MARKER)).count()
    held = sessions.agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0]
    return SessionRun(sessions, seen - held if close else None, state)


def unique_events(stream: DataFrame, keys: list[str], ts_col: str = "ts", delay: str = "2 days") -> DataFrame:
    return _timed(stream, ts_col, delay).dropDuplicatesWithinWatermark(keys).drop("__ets")


def run_unique(spark: SparkSession, source_path: str, out_path: str, checkpoint: str, keys: list[str],
               delay: str = "2 days", files: int = 2, schema: str = EVENTS_SCHEMA) -> tuple[DataFrame, list[int]]:
    """Each event once, and the rows of state after each micro-batch. ``delay`` is at
    least the time between an event and its last repeat."""
    stream = _events(spark, source_path, schema, files)
    q = _run(unique_events(stream, keys, delay=delay).writeStream.outputMode("append")
             .foreachBatch(_appender(out_path)).option("checkpointLocation", checkpoint))
    return spark.read.schema(schema).parquet(f"{out_path}/epoch=*"), state_rows(q)


def stream_latest(spark: SparkSession, batch_root: str, state: LatestState, checkpoint: str, files: int = 16) -> DataFrame:
    """SNAP1 as a stream: every micro-batch of new batch files is merged into the kept
    latest rows. A micro-batch that is replayed merges to the same rows."""
    table = state.table
    stream = (spark.readStream.schema(f"{table.ddl}, ds string, run string").option("maxFilesPerTrigger", files)
              .parquet(batch_root).select(*table.column_names, batch_order().alias("load_seq")))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        state.kept.merge(stamp_loaded_at(coerce_to_contract(batch, table.schema)))
    _run(stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint))
    return state.read()
