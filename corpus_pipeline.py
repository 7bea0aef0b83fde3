"""From raw documents to packed training sequences.

Each stage takes the documents that the one before kept, as (spark, docs, sf_dir), and
returns those it keeps in the columns of `documents`; the last returns the packed pieces.
Nulls, empty texts, repeated rows and empty tables are handled as each operator states.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from oncallmart import session
from oncallmart.llm import decontaminate, near_dedup, packing, personal, quality
from oncallmart.llm.queries import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return near_dedup.without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return personal.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]
# Trained trees, expectation-maximisation and a public tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet and read by the next."""
    session.use_shared_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
