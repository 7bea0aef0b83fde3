"""Bronze files in, Silver months out, each file once.

The daily schedule is a daily batch. Run with `available_now` this is that
batch without rereading old files; the rules are those of the batch job because
they are the same function, applied to rows without state.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from oncallmart import schema as S
from oncallmart.operators import silver


def bronze_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(S.BRONZE).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def load_silver(bronze: DataFrame, path: str, checkpoint: str,
                min_date: str = S.MIN_DATE) -> StreamingQuery:
    """Start the load; it stops by itself when all present files are in."""
    return (
        silver.silver(silver.since(bronze, min_date))
        .writeStream.format("parquet")
        .partitionBy("Ano_Mes")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
