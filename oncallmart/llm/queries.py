"""Registered queries of the corpus operators, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oncallmart.llm import (
    decontaminate,
    filter_audit,
    fingerprint,
    mixing,
    near_dedup,
    oracle_sql,
    packing,
    personal,
    pieces,
    quality,
    rollup,
    sharding,
    url_filter,
    vector_codes,
)
from oncallmart.session import tune


# Rows of whole texts in one batch that goes to Python.
BATCH_ROWS = "2000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_context_mixing(spark, folder):
    return mixing.score_documents(table(spark, folder, "documents"))


def op2_personal_data(spark, folder):
    return personal.personal_data(table(spark, folder, "documents"))


def op3_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op4_token_rollup(spark, folder):
    return rollup.document_rollup(table(spark, folder, "documents"))


def op5_quality(spark, folder):
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_shards(spark, folder):
    return sharding.assign(table(spark, folder, "documents"))


def op8_decontamination(spark, folder):
    return decontaminate.contained(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op9_url_verdicts(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"))


def op10_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"))


def op7_fingerprints(spark, folder):
    return fingerprint.fingerprints(table(spark, folder, "documents"))


def op11_vector_codes(spark, folder):
    return vector_codes.codes(table(spark, folder, "embeddings"))


def op12_filter_audit(spark, folder):
    return filter_audit.filter_steps(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_pieces(spark, folder):
    return pieces.digests(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_context_mixing, op2_personal_data, op3_near_dedup, op4_token_rollup, op5_quality, op6_shards,
        op7_fingerprints, op8_decontamination, op9_url_verdicts, op10_packing,
        op11_vector_codes, op12_filter_audit, op13_pieces,
    )
}
ORACLES = oracle_sql.STATEMENTS
