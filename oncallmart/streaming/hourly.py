"""Hourly volume of events by type, each window published once.

Events may come late by `late` behind the newest event of the batches before; a window is
published when nothing of it can come any more, and its state is dropped. Rows that come
later than that are not counted in any window: `late_rows` says how many they were. A load
that starts again from its checkpoint goes on where it stopped. An event without a time is in
no window and never late; one without a type has the type null.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id bigint, ts timestamp_ntz, event_type string"
VOLUME = "hour timestamp, event_type string, volume bigint"


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = 1000) -> DataFrame:
    """Without a number of files, all that are present make one batch, in which no row is late."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def hourly_volume(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Rows of a window and type are counted before they move, so a hot type stays cheap."""
    return (
        events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
        .where("ts is not null")
        .withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour").alias("window"), "event_type")
        .agg(F.count("*").alias("volume"))
        .select(F.col("window.start").alias("hour"), "event_type", "volume")
    )


def load_volume(events: DataFrame, path: str, checkpoint: str, late: str = "10 minutes") -> StreamingQuery:
    """Start the load; it stops by itself when all present files are in."""
    return (
        hourly_volume(events, late)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def volume(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOLUME).parquet(path)


def open_volume(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that are still open, from the state of the last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.window.start").alias("hour"), F.col("key.event_type").alias("event_type"),
        F.col("value.count").alias("volume"),
    )


def late_rows(events: DataFrame, path: str, checkpoint: str) -> int:
    """How many of the loaded events came too late for their window."""
    spark = events.sparkSession
    counted = volume(spark, path).select("volume").unionByName(open_volume(spark, checkpoint).select("volume"))
    return events.where("ts is not null").count() - (counted.agg(F.sum("volume")).first()[0] or 0)
