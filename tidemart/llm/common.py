"""Shared helpers of the text operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import apply_sql_conf, checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings of the text operators: small Arrow batches (texts may be
    very long), and the package's folder on the path of local Python workers
    (on a cluster the package is installed or shipped with --py-files)."""
    apply_sql_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in have and _ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *have])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage with
    files that survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else (``lower`` maps all of Unicode)."""
    return F.translate(col, UPPER, LOWER)


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only: extra columns of any name cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def once_each(docs: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` are in ``kept`` (null-safe), one for each
    key: rows repeated under one key are reduced, in a further shuffle that is
    only planned when a key of ``kept`` occurs more than once."""
    kept = stored(kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                  .select(*(F.col(k).alias(f"__kept{i}") for i, k in enumerate(keys)), "__n"), "kept")
    same = None
    for i, k in enumerate(keys):
        one = docs[k].eqNullSafe(kept[f"__kept{i}"])
        same = one if same is None else same & one
    out = docs.join(kept, same, "left_semi")
    return out if kept.where("__n > 1").isEmpty() else out.dropDuplicates(keys)


def utf8_rows(column) -> Iterable[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes (null: empty)."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind).to_pylist():
        yield v if v is not None else b""


SAMPLE_TEXT = 1 << 16   # bytes; longer texts are not fitted on (they are scored like any other)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, where: Column | None = None) -> list:
    """At most ``rows`` labelled documents (doc_id, text, quality, toxic) to fit on,
    in the order of a hash of doc_id, so they are spread evenly over the corpus.
    The documents are read once and joined to the ``rows`` picked labels."""
    picked = (labels.select("doc_id", "quality", "toxic").dropna().dropDuplicates(["doc_id"])
              .withColumn("h", F.xxhash64("doc_id")))
    if where is not None:
        picked = picked.where(where)
    picked = F.broadcast(picked.orderBy("h", "doc_id").limit(rows))     # ``rows`` rows whatever the data
    found = (rows_of(docs).where(F.octet_length("text") <= SAMPLE_TEXT).join(picked, "doc_id")
             .orderBy("h", "doc_id", "text").limit(rows))
    return found.select("doc_id", "text", "quality", "toxic").collect()


def uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def put_file(folder: str, name: str, data) -> None:
    """Writes a file (bytes, or pieces of them) whole or not at all, in any store that Arrow can open."""
    from pyarrow import fs
    from pyspark import TaskContext
    store, base = fs.FileSystem.from_uri(uri(folder))
    store.create_dir(base, recursive=True)
    task = TaskContext.get()
    draft = f"{base}/.{name}.{task.taskAttemptId() if task else 0}"
    with store.open_output_stream(draft) as f:
        for piece in [data] if isinstance(data, bytes) else data:
            f.write(piece)
    store.move(draft, f"{base}/{name}")


def open_file(folder: str, name: str):
    """A file of ``put_file`` for random reads (``size``, ``seek``, ``read``)."""
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(uri(folder))
    return store.open_input_file(f"{base}/{name}")
