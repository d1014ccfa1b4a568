"""Exact dedup against a persistent digest index.

Method: the index is a table bucketed and sorted by digest. A new batch is
digested, grouped by digest, left-anti joined to the index by sort-merge (the
bucketed side is not shuffled) and the digests not seen before are appended,
so the index grows batch by batch and later sessions can reopen it.

Two texts are equal when they are identical after lower-casing A-Z. Of equal
texts in the batch that first brings them, the row with the largest doc_id
stays; later batches lose all their copies to the indexed row.

A group of copies may hold a third of all rows. Rows are therefore counted per
(digest, salt), the salt being a hash of doc_id, and decisions travel back to
the rows per (digest, salt): no task holds a whole group.

Defined cases: null text counts as empty; a null doc_id is smaller than any
other and joins null-safely; a repeated row (same doc_id, same text) gives one
output row per copy, of which the first copy only can be ``kept``; an empty
table gives an empty result and adds nothing to the index; extra columns are
not looked at."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower, once_each, prepare, rows_of, scratch, stored, table, text_or_empty

SALTS = 64      # parts of one group of copies
BUCKETS = 64    # buckets of the index; thousands for a corpus of 100 TB


def digest(text):
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


class DigestIndex:
    """A bucketed, sorted table (digest, keep_id, copies, batch)."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, buckets: int = BUCKETS):
        prepare(spark)
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} "
                  "(digest BINARY, keep_id BIGINT, copies BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Adds the digests of ``groups`` (digest, keep_id, copies) that the index does not hold."""
        fresh = groups.hint("merge").join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id", "copies", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest")
         .write.insertInto(self.name))

    def admit(self, docs: DataFrame) -> DataFrame:
        """Deduplicates a batch against the index and itself, appends what is new
        and returns one row per row of ``docs``: doc_id, keep_id, group_size (rows
        of this text in the batch and, for an older text, in the batch that brought
        it), kept, digest, new (the batch brought the text)."""
        batch = uuid.uuid4().hex
        # one row per (text, doc_id); copies of a row are counted, not kept apart
        rows = stored(rows_of(docs).select("doc_id", digest(F.col("text")).alias("digest"))
                      .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
                      .groupBy("digest", "salt", "doc_id").agg(F.count(F.lit(1)).alias("n")), "digests")
        parts = rows.groupBy("digest", "salt").agg(F.max("doc_id").alias("m"), F.sum("n").alias("n"))
        groups = stored(parts.groupBy("digest")
                        .agg(F.max("m").alias("keep_id"), F.sum("n").alias("copies"),
                             F.collect_list("salt").alias("salts")), "digest-groups")  # at most SALTS entries
        self.append(groups, batch)
        index = self.read().select("digest", F.col("keep_id").alias("index_id"),
                                   F.col("copies").alias("index_copies"), F.col("batch"))
        new = F.col("batch") == batch
        decided = (groups.hint("merge").join(index.hint("merge"), "digest")
                   .select("digest", F.explode("salts").alias("salt"), F.col("index_id").alias("keep_id"),
                           F.when(new, F.col("copies")).otherwise(F.col("copies") + F.col("index_copies"))
                           .alias("group_size"), new.alias("new")))
        return (rows.join(decided, ["digest", "salt"])
                .select("doc_id", "keep_id", "group_size", "digest", "new",
                        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
                .select("doc_id", "keep_id", "group_size",
                        (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
                         & (F.col("copy") == 1)).alias("kept"), "digest", "new"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Decisions for every row of ``docs`` (see ``DigestIndex.admit``); without an
    index, against a new empty one."""
    spark = docs.sparkSession
    return (index or DigestIndex(spark, scratch(spark, "digest-index"))).admit(docs)


def drop_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``docs`` without the rows that lose; all columns kept."""
    decided = exact_dedup(docs, index)
    stays = decided.where("new").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    mine = docs.withColumn("__digest", digest(text_or_empty()))
    return once_each(mine, stays.select("doc_id", F.col("digest").alias("__digest")),
                     ["doc_id", "__digest"]).drop("__digest")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept",
                    F.lower(F.hex("digest")).alias("text_sha256")))


OP3_SQL = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}',
                                 '{"abcdefghijklmnopqrstuvwxyz"}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d"""
