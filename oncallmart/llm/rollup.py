"""Token totals kept by signed deltas and idempotent batch commits.

A change is an insert (+1), a delete (-1) or a revised count, which is a delete of the old
count and an insert of the new one. A batch of changes is summed to one signed row for each
(source, lang, tokenizer version) and stored in a folder of its own. The folder is committed
by the writer's `_SUCCESS` file, which appears last: a batch with that file is never applied
again, one without it (lost driver or executors) is written anew. Totals are the sums over
committed batches, so replays and the order of batches change nothing.

Null source and lang are groups of their own. A null or empty text has no tokens and counts
as a document. A group whose rows were all taken back stays, with zeros. Further columns
are ignored; an empty batch commits and adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncallmart import session

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
# Tokenizer versions: words, and words with each punctuation byte as a token of its own.
WORDS, PIECES = "words/1", "words/2"
PATTERNS = {WORDS: "[^\\x20\\x09-\\x0D]+", PIECES: "[^\\x20-\\x2F\\x3A-\\x40\\x09-\\x0D]+|[\\x21-\\x2F\\x3A-\\x40]"}


def count_tokens(text: str, tokenizer: str):
    return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[tokenizer])), F.lit(0)).cast("bigint")


def insert(rows: DataFrame) -> DataFrame:
    """Signed changes that add `rows` (source, lang, tokenizer, tokens)."""
    return rows.select(*KEYS, F.col("tokens").cast("bigint").alias("tokens"), F.lit(1).cast("bigint").alias("sign"))


def delete(rows: DataFrame) -> DataFrame:
    return insert(rows).withColumn("sign", -F.col("sign"))


def revise(old: DataFrame, new: DataFrame) -> DataFrame:
    return delete(old).union(insert(new))


class Store:
    """A folder of committed batches that every executor can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _there(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: str) -> bool:
        return self._there(f"{self.path}/batch={batch}/_SUCCESS")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it had been committed before."""
        if self.committed(batch):
            return False
        sums = changes.groupBy(*KEYS).agg(
            F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Totals over those of `batches` that are committed."""
        done = [f"{self.path}/batch={b}" for b in batches if self.committed(b)]
        rows = (
            self.spark.read.schema(DELTA).parquet(*done) if done else self.spark.createDataFrame([], DELTA)
        )
        return rows.groupBy(*KEYS).agg(
            F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
        )


def document_rollup(documents: DataFrame) -> DataFrame:
    """Totals after four batches over all documents: all are inserted with the first
    tokenizer; all are revised to the second; later copies of a text (not the least doc_id)
    are deleted; and the second batch arrives once more, which changes nothing."""
    spark = documents.sparkSession
    counted = session.settle(
        documents.select(
            "doc_id", "source", "lang", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"),
            count_tokens("text", WORDS).alias("words"), count_tokens("text", PIECES).alias("pieces"),
        )
    )
    old = counted.select("source", "lang", F.lit(WORDS).alias("tokenizer"), F.col("words").alias("tokens"))
    new = counted.select("source", "lang", F.lit(PIECES).alias("tokenizer"), F.col("pieces").alias("tokens"))
    firsts = counted.groupBy("text_md5").agg(F.min("doc_id").alias("first"))
    copies = (
        counted.join(firsts, "text_md5").where("doc_id > first")
        .select("source", "lang", F.lit(PIECES).alias("tokenizer"), F.col("pieces").alias("tokens"))
    )
    session.use_shared_checkpoints(spark)
    store = Store(spark, f"{spark.sparkContext.getCheckpointDir()}/rollup-{uuid.uuid4().hex}")
    store.commit("1", insert(old))
    store.commit("2", revise(old, new))
    store.commit("3", delete(copies))
    store.commit("2", revise(old, new))
    return store.totals(["1", "2", "3"])
