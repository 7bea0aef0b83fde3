"""Shards by jump consistent hashing: no ring table, and little moves when shards are added.

The stable key is doc_id (null counts as the key 0). With one more shard a row either stays
or goes into the new shard. Slots number the rows of a shard without gaps; repeated rows get
a slot each. A null text counts as empty. Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
ROW_BYTES = 8
# Rows that one numbering task takes, about.
BLOCK_ROWS = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, after Lamping and Veach's jump consistent hash."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    todo = np.arange(len(keys))
    while len(todo):
        at[todo] = ahead[todo]
        state[todo] = state[todo] * np.uint64(2862933555777941757) + np.uint64(1)
        high = (state[todo] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[todo] = ((at[todo] + 1) * (float(1 << 31) / high)).astype(np.int64)
        todo = todo[ahead[todo] < shards]
    return at.astype(np.int32)


def shard_of(key: str, shards: int):
    """Column with the shard of a hashed 64-bit key column."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards))

    return place(F.xxhash64(F.coalesce(F.col(key).cast("bigint"), F.lit(0).cast("bigint"))))


def number_rows(rows: DataFrame, group: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`rows` with slot: 0, 1, ... inside each of the few groups (their
    totals are broadcast: one row per shard). Repeated rows are
    counted first; a group is cut into blocks by a hash of its rows, blocks are numbered apart
    and moved behind the blocks before them, so no task holds a whole group."""
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("_m"))
    totals = counted.groupBy(group).agg(F.ceil(F.count("*") / block_rows).alias("_blocks"))
    cut = counted.join(F.broadcast(totals), group).withColumn(
        "_block", F.pmod(F.xxhash64(*names), "_blocks")
    )
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(group, "_block").agg(F.sum("_m").alias("_c"))
        .select(group, "_block", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy(group, "_block").orderBy(*names)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.withColumn("_to", F.sum("_m").over(inside))
        .join(starts, [group, "_block"])
        .select(
            *names,
            F.explode(
                F.sequence(F.col("_start") + F.col("_to") - F.col("_m"), F.col("_start") + F.col("_to") - 1)
            ).alias("slot"),
        )
    )


def assign(documents: DataFrame, shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each document's size, checksum, shard, slot and shard with one more shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).select(
        "*", F.lit("key").alias("law"),
        shard_of("doc_id", shards).alias("shard"), shard_of("doc_id", shards + 1).alias("grown_shard"),
    )
    return number_rows(rows, "shard", block_rows).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents with one folder per shard; a shard's rows stay spread over tasks."""
    documents.withColumn("shard", shard_of("doc_id", shards)).write.partitionBy("shard").parquet(path)
