"""Sharding by a permutation-filled lookup table (built-in functions only).

Method: every shard has its own order of preference over the slots of a table
of prime size (a start and a step derived from the shard's name; any step
below a prime visits every slot). The shards take turns; at its turn a shard
claims its first slot that is still free. A row's key is hashed to a slot and
a broadcast join with the table (its size is the parameter ``slots``, not the
data) finds the shard in constant time. Shards get nearly equal numbers of
slots, and adding or losing a shard moves few slots beside its own.
The registered query writes the whole documents into a folder for each shard of
the shared folder and returns what is read back from these.

Defined cases: a null key hashes like the empty string; repeated keys go to
one shard; an empty table gives an empty result; extra columns of any name are
kept and come back as they were: within, slot and shard have reserved names, and
a file's other columns are stored by place."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemart.llm.common import scratch, table

SLOT, SHARD = "__slot", "__shard"       # reserved names
SLOTS = 8191        # a prime, over 100 slots for each shard
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _preference(name: str, slots: int) -> tuple[int, int]:
    h = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """slot -> index of the shard that claimed it."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"the number of slots must be prime, not {slots}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be one or more different names, no more than slots")
    prefs = [_preference(s, slots) for s in shards]
    at = [start for start, _ in prefs]
    owner = [-1] * slots
    left = slots
    while True:
        for k, (_, step) in enumerate(prefs):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + step) % slots
            owner[at[k]] = k
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5, modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"),
                  F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard), ``slots`` rows."""
    owners = F.from_json(F.lit(json.dumps(lookup_table(shards, slots))), "array<int>")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))


def _placed(df: DataFrame, key: Column, shards: Sequence[str], slots: int) -> DataFrame:
    """SLOT, SHARD and the columns of ``df`` by place: _0, _1, ..."""
    names = df.schema.names
    rows = df.select(slot_of(key, slots).alias(SLOT), F.struct("*").alias("row"))
    lookup = F.broadcast(table_frame(df.sparkSession, shards, slots).toDF(SLOT, SHARD))     # ``slots`` rows whatever the data
    return rows.join(lookup, SLOT).select(SLOT, SHARD, *(F.col("row")[n].alias(f"_{k}") for k, n in enumerate(names)))


def place(df: DataFrame, key: Column, shards: Sequence[str] = SHARDS, slots: int = SLOTS,
          slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with two more columns, the slot and the shard (index into ``shards``); they
    have the names given, and the columns of ``df`` keep theirs."""
    names = df.schema.names
    if {slot, shard} & {*names}:
        raise ValueError(f"the table has a column {slot} or {shard}: give other names")
    return _placed(df, key, shards, slots).select(
        *(F.col(f"_{k}").alias(n) for k, n in enumerate(names)), F.col(SLOT).alias(slot), F.col(SHARD).alias(shard))


def write_shards(df: DataFrame, key: Column, path: str, shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS) -> None:
    """One folder ``__shard=<index>`` for each shard; the rebalance hint gathers a
    shard's rows and splits a large shard over several write tasks."""
    placed = _placed(df, key, shards, slots).drop(SLOT)
    placed.hint("rebalance", SHARD).write.partitionBy(SHARD).mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType, shard: str | None = "shard") -> DataFrame:
    """The rows of ``write_shards`` (columns of ``schema``) and, under the name ``shard``, the
    shard of the folder each is in."""
    stored = StructType([*(StructField(f"_{k}", f.dataType) for k, f in enumerate(schema.fields)), StructField(SHARD, IntegerType())])
    back = spark.read.schema(stored).parquet(path)
    cols = [F.col(f"_{k}").alias(n) for k, n in enumerate(schema.names)]
    return back.select(*cols, *([F.col(SHARD).alias(shard)] if shard else []))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark, "shards")
    write_shards(docs, F.col("doc_id"), path)
    back = read_shards(spark, path, docs.schema, SHARD)
    return back.select("doc_id", slot_of(F.col("doc_id")).alias("slot"), F.col(SHARD).alias("shard"))
