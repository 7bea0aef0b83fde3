"""Session settings and the shared folder for checkpoints."""

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on; all of these can be set on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins whose key may hold a large share of the rows rely on these two.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The wide ticket projections compile to methods too long for the JIT (8000 bytes
    # of bytecode); beyond that, code split into small methods is three times as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
SETTINGS = {
    **SQL_SETTINGS,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Building a plan makes thousands of calls; recording where each came from doubles them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


# Applications whose workers have the package.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they find it
    wherever they run and whatever folder the driver was started in."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="oncallmart-package-")) / "oncallmart.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as made:
        for source in sorted(package.rglob("*.py")):
            made.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    ship(spark)
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "oncallmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    made = builder.getOrCreate()
    ship(made)
    return made


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Point checkpoints at the cluster's shared folder, once per session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="oncallmart-checkpoint-")
    context.setCheckpointDir(shared)


# Folders of stored copies, by application.
_settled: dict[str, list[str]] = {}


def settled(spark: SparkSession) -> int:
    """How many stored copies this application has made and not discarded."""
    return len(_settled.get(spark.sparkContext.applicationId, []))


def discard_settled(spark: SparkSession, keep: int = 0) -> int:
    """Delete the stored copies that this application made after the first `keep`; frames
    read from them end here. Returns their number."""
    own = _settled.get(spark.sparkContext.applicationId, [])
    paths, own[keep:] = own[keep:], []
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one stored copy before the others."""
    own = _settled.get(spark.sparkContext.applicationId, [])
    if path in own:
        own.remove(path)
        _delete(spark, path)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared checkpoint folder, deleted with the stored copies."""
    use_shared_checkpoints(spark)
    return adopt(spark, f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}")


def adopt(spark: SparkSession, path: str) -> str:
    """Count a path among the stored copies."""
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(frame: DataFrame) -> DataFrame:
    """Store a frame that several jobs will read, and read it back.

    A Parquet copy in the shared checkpoint folder cuts the lineage, survives the
    loss of executors, gives every reader the same rows, and still lets each
    reader prune columns and filter at the scan.
    """
    spark = frame.sparkSession
    path = scratch(spark, "settled")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def side_by_side(spark: SparkSession, jobs: list[Callable], at_once: int = 4) -> list:
    """Run independent fits at the same time; each one is a chain of small Spark jobs
    whose waits the others fill. Results come back in the order of the jobs."""
    inherit = inheritable_thread_target(spark)
    with ThreadPool(at_once) as pool:
        running = [pool.apply_async(inherit(job)) for job in jobs]
        return [result.get() for result in running]
