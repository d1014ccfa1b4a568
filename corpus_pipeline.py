"""The corpus pipeline: documents -> filtered, deduplicated, encoded corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
every stage's result as Parquet in the shared folder and reads it again as the
next stage's docs, so a lost executor costs one stage at most. All stages but
the last return the columns of ``documents`` (and any extra ones).

Rows with nulls, empty texts, repeated rows and empty tables are handled as
each operator's module says; in short: a null text is an empty one, a null
doc_id is a document of its own, and of rows that repeat as a whole one stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import byte_bpe, decontam, exact_dedup, simhash, toxicity
from tidemart.llm.common import prepare, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    prepare(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the largest doc_id."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints stays: the smallest doc_id."""
    prepare(spark)
    return simhash.drop_near(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of the ids and of what they decode to."""
    prepare(spark)
    return byte_bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

# Trained scores, fingerprints and token ids have no SQL form; the pipeline is
# tested against a brute-force version instead (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
