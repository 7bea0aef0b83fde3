"""Stored copies that end before the job does.

A copy is written once into the shared checkpoint folder and read from its path; what has
been read for the last time is deleted, so that a long job does not hold all of its steps.
"""

from pyspark.sql import DataFrame, SparkSession

from oncallmart.session import scratch


def stored(frame: DataFrame, *folders: str) -> str:
    """Path of a compact copy, with a folder for each value of the given columns."""
    path = scratch(frame.sparkSession, "stored")
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(*folders) if folders else writer).parquet(path)
    return path


def discard_stored(spark: SparkSession, path: str) -> None:
    """Delete a copy, or one folder of it; frames read from it end here."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
