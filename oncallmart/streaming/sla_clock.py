"""SLA clock: an alert for every ticket whose contract time runs out before it is resolved.

The stream brings a record whenever something is known of a ticket: it was opened, or it was
resolved. The time of a record is that of the resolution, else of the opening, and the clock
(the watermark) stands `late` behind the newest record of the batches before. When it reaches a
ticket's deadline, the ticket is decided by all records that have come until then, however
late or often and in whatever order: no resolution, or one after the deadline, gives the
alert. Its state ends there, so records that come after that change nothing, and state is
held for running clocks only. Alerts do not depend on batches or restarts, as long as no
record comes later than its ticket's decision.

Every priority that a ticket's records name runs a clock of its own from the opening, and a
resolution stops them all. Records without a number or an opening time have no clock; an
unknown priority counts as the lowest. Rows of a clock are combined before they move, so a
ticket that is repeated very often stays cheap. With many running clocks, keep the state in
RocksDB (`spark.sql.streaming.stateStore.providerClass`).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oncallmart import schema as S
from oncallmart.functions import tickets as X

RECORDS = "Numero string, Prioridade string, Aberto timestamp_ntz, Resolvido timestamp_ntz"
ALERTS = "incident_id string, opened timestamp_ntz, deadline timestamp_ntz, contract_hours int"


def record_stream(spark: SparkSession, path: str, files_per_batch: int | None = 1000) -> DataFrame:
    """Without a number of files, all that are present make one batch, in which no row is late."""
    reader = spark.readStream.schema(RECORDS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def clocks(records: DataFrame, limits: dict[int, int] = S.CONTRACT_HOURS) -> DataFrame:
    """incident_id, opened, contract_hours, deadline, and what a record (at) says of that clock:
    it runs (starts), it was stopped (stopped). A resolution speaks of the clocks of all limits."""
    given = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    own = F.coalesce(
        F.element_at(given, X.priority_number(F.col("Prioridade"))), F.lit(limits[S.FALLBACK_PRIORITY])
    )
    every = F.array(*[F.lit(h) for h in sorted(set(limits.values()))])
    opened, stopped = F.col("Aberto").cast("timestamp"), F.col("Resolvido").cast("timestamp")
    return (
        records.where("Numero is not null and Aberto is not null")
        .select(
            F.col("Numero").alias("incident_id"), opened.alias("opened"), stopped.alias("stopped"),
            F.coalesce(stopped, opened).alias("at"), own.alias("own"),
            F.explode(F.when(stopped.isNull(), F.array(own)).otherwise(every)).alias("contract_hours"),
        )
        .select(
            "incident_id", "opened", "contract_hours", "at", "stopped",
            (F.col("contract_hours") == F.col("own")).alias("starts"),
            (F.col("opened") + F.make_dt_interval(hours=F.col("contract_hours"))).alias("deadline"),
        )
    )


def alerts(records: DataFrame, late: str = "1 hour", limits: dict[int, int] = S.CONTRACT_HOURS) -> DataFrame:
    """A group of rows is published when the watermark reaches its deadline. One column of a stream
    can set its watermark, so the records are read twice, once for their deadlines and once for
    their times, and Spark takes the smaller watermark of the two: the newest record less
    `late`, or the last deadline, beyond which no clock is running."""
    told = ["incident_id", "opened", "deadline", "contract_hours", "starts", "stopped"]
    running = clocks(records, limits).where("starts").withWatermark("deadline", "0 seconds")
    return (
        running.select(*told)
        .union(clocks(records, limits).withWatermark("at", late).select(*told))
        .groupBy("incident_id", "opened", "deadline", "contract_hours")
        .agg(F.bool_or("starts").alias("starts"), F.min("stopped").alias("stopped"))
        .where("starts and (stopped is null or stopped > deadline)")
        .select(
            "incident_id", F.col("opened").cast("timestamp_ntz").alias("opened"),
            F.col("deadline").cast("timestamp_ntz").alias("deadline"), "contract_hours",
        )
    )


def load_alerts(records: DataFrame, path: str, checkpoint: str, late: str = "1 hour",
                limits: dict[int, int] = S.CONTRACT_HOURS) -> StreamingQuery:
    """Start the clock; it stops by itself when all present files are in."""
    return (
        alerts(records, late, limits)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def told(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERTS).parquet(path)


def ticket_records(bronze: DataFrame) -> DataFrame:
    """The records of whole tickets: one of the opening, and one of the resolution if there is one."""
    columns = ["Numero", "Prioridade", "Aberto", "Resolvido"]
    opening = bronze.select(*columns[:3], F.lit(None).cast("timestamp_ntz").alias("Resolvido"))
    return opening.unionByName(bronze.where("Resolvido is not null").select(*columns))
