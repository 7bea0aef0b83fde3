"""Writing tables: partitioned Silver, serving loads, exports and their checks."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oncallmart.sources import versions
from oncallmart.sources.versions import LoadMismatch


class ExportFailed(Exception):
    """Some tables of an export could not be written; the others were."""


@dataclass(frozen=True)
class Written:
    path: str
    rows: int
    months: tuple[str, ...] = ()


def _observed(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, instead of scanning twice."""
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_monthly(frame: DataFrame, path: str, month: str = "Ano_Mes") -> Written:
    """Overwrite the months present in the frame, leaving other months alone.

    Rebalancing by month gives each month few files of even size: small months
    share a task and a month that holds much of the data is split over several.
    """
    seen = Observation()
    counted = frame.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(month).cast("string")).alias("months")
    ).hint("rebalance", month)
    (
        counted.write.partitionBy(month)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    return Written(path, seen.get["rows"], tuple(sorted(seen.get["months"])))


def verify_monthly(spark: SparkSession, written: Written, month: str = "Ano_Mes") -> DataFrame:
    """Read back the months that were written and compare the count; other months of the
    folder, from earlier loads, are not looked at. Returns rows per month."""
    kept = spark.read.parquet(written.path).where(
        F.col(month).cast("string").isin(list(written.months))
    )
    months = kept.groupBy(month).agg(F.count("*").alias("tickets"))
    found = months.agg(F.sum("tickets")).first()[0] or 0
    if found != written.rows:
        raise LoadMismatch(f"{written.path}: wrote {written.rows} rows, found {found}")
    return months


def with_audit(frame: DataFrame, batch_time: str) -> DataFrame:
    """Load time columns; the time is a parameter, so a rerun writes the same rows."""
    at = F.lit(batch_time).cast("timestamp_ntz")
    return frame.withColumns({"loaded_at": at, "updated_at": at})


def publish(frame: DataFrame, path: str, batch_time: str) -> Written:
    """Replace a serving table kept as Parquet; executors write, nothing is collected. Until
    all is written readers (`versions.read`) see the old rows, and then the new ones; the
    version before is kept for those that are reading it."""
    made = versions.publish(with_audit(frame, batch_time), path)
    versions.clean(frame.sparkSession, path)
    return Written(path, made.rows)


def publish_jdbc(frame: DataFrame, url: str, table: str, batch_time: str,
                 properties: dict[str, str], batch: int = 10_000, writers: int = 8) -> int:
    """Truncate and load a database table over at most `writers` connections."""
    counted, seen = _observed(with_audit(frame, batch_time).repartition(writers))
    (
        counted.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", batchsize=str(batch), **properties)
        .mode("overwrite")
        .save()
    )
    return seen.get["rows"]


def verify(spark: SparkSession, written: Written) -> bool:
    """Does the serving table hold the number of rows that was written?"""
    return versions.read(spark, written.path).count() == written.rows


def write_run(records: DataFrame, path: str) -> None:
    """Store the records of runs; the same run again replaces its records."""
    (
        records.write.partitionBy("run_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def write_output(frame: DataFrame, path: str, csv: bool = False) -> None:
    """A model output as Parquet, and as CSV next to it when asked for."""
    frame.write.mode("overwrite").parquet(path)
    if csv:
        written = frame.sparkSession.read.parquet(path)
        written.write.mode("overwrite").option("header", True).csv(f"{path}_csv")


def export_all(tables: dict[str, Callable[[], DataFrame]],
               path_of: Callable[[str], str]) -> dict[str, Written]:
    """Write every table; one that fails does not stop the others."""
    done: dict[str, Written] = {}
    failed: dict[str, str] = {}
    for name, build in tables.items():
        try:
            counted, seen = _observed(build())
            counted.write.mode("overwrite").parquet(path_of(name))
            done[name] = Written(path_of(name), seen.get["rows"])
        except Exception as error:  # any cause: report it with the others
            failed[name] = f"{type(error).__name__}: {error}"
    if failed:
        raise ExportFailed(f"{len(done)} tables written, failed: {failed}")
    return done


def table_names(spark: SparkSession, prefix: str = "") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))
