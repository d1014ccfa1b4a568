"""Registered queries of the text operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import (
    byte_bpe,
    decontam,
    exact_dedup,
    filter_audit,
    licences,
    merkle,
    quality,
    secrets,
    sharding,
    simhash,
    simple8b,
    toxicity,
    warc,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    "op1_decontamination": decontam.op1_decontamination,
    "op2_simple8b": simple8b.op2_simple8b,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_sharding": sharding.op5_sharding,
    "op6_simhash": simhash.op6_simhash,
    "op7_secrets": secrets.op7_secrets,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_quality": quality.op9_quality,
    "op10_licences": licences.op10_licences,
    "op11_merkle": merkle.op11_merkle,
    "op12_warc": warc.op12_warc,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

SQL: dict[str, str] = {
    "op1_decontamination": decontam.OP1_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_warc": warc.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
