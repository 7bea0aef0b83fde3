"""Tables whose readers see one whole version, and loads that keep what they do not bring.

Every load writes its files into a folder of its own, `data/load=<id>`, and then adds one
small file, `_versions/<number>.json`, that names the folders the table consists of. The
file is written aside and renamed, which fails if the number is taken: a load that stops
half-way leaves files that no version names, and of two loads at once one starts over.
Readers take the highest number. `clean` deletes what the versions to keep do not name.

The number of parts of a table is that of its months; rows stay on the executors.
"""

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncallmart.session import settle

LOAD = "load"


class LoadMismatch(Exception):
    """What was written is not what was meant to be written."""


class Conflict(Exception):
    """Another load committed first; this one has to be done again."""


@dataclass(frozen=True)
class Version:
    """Parts maps a folder below a load ('' for a table without months) to its load."""

    path: str
    number: int
    rows: int
    parts: dict[str, str] = field(default_factory=dict)
    shape: str = ""
    month: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.shape))


@dataclass(frozen=True)
class Merged:
    """What a load did: rows of the table before, replaced by it, brought by it, and after."""

    version: Version
    before: int
    replaced: int
    brought: int


class _Folder:
    """The few file operations that are needed, on whatever file system the path lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark._jvm, spark._sc._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.path = path
        self.fs = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        if not self.fs.exists(self.at(name)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name)))

    def read(self, name: str) -> str:
        source = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def add(self, name: str, text: str) -> bool:
        """Whole or not at all; False if the name is taken."""
        aside = f"{name}.{uuid.uuid4().hex}.tmp"
        target = self.fs.create(self.at(aside), False)
        target.write(bytearray(text.encode()))
        target.close()
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(self.at(aside), self.at(name), options)
        except Exception as error:  # py4j wraps the file system's own exception
            self.delete(aside)
            if self.fs.exists(self.at(name)):
                return False
            raise error
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def age(self, name: str) -> float:
        return time.time() - self.fs.getFileStatus(self.at(name)).getModificationTime() / 1000


def _numbers(folder: _Folder) -> list[int]:
    return [int(n[:-5]) for n in folder.names("_versions") if n.endswith(".json")]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version of a table, or a given one; None before the first load."""
    folder = _Folder(spark, path)
    number = number if number is not None else max(_numbers(folder), default=None)
    if number is None:
        return None
    return Version(path=path, **json.loads(folder.read(f"_versions/{number:010d}.json")))


def frame_of(spark: SparkSession, table: Version, months: list[str] | None = None) -> DataFrame:
    """Rows of a version, of all months or of some of its parts."""
    parts = [p for p in sorted(table.parts) if months is None or p in months]
    paths = [f"{table.path}/data/{LOAD}={table.parts[p]}" + (f"/{p}" if p else "") for p in parts]
    if not paths:
        return spark.createDataFrame([], table.schema)
    shape = T.StructType([*table.schema, T.StructField(LOAD, T.StringType())])
    found = spark.read.schema(shape).option("basePath", f"{table.path}/data").parquet(*paths)
    return found.select(table.schema.names)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path} has no version")
    return frame_of(spark, found)


def _store(frame: DataFrame, path: str, month: str | None) -> tuple[str, dict[str, str], int]:
    """Write the rows into a new load; returns its id, its parts and its rows as read back."""
    spark, load = frame.sparkSession, uuid.uuid4().hex
    place = f"data/{LOAD}={load}"
    if month is None:
        frame.write.parquet(f"{path}/{place}")
        parts = {"": load}
    else:
        frame.hint("rebalance", month).write.partitionBy(month).parquet(f"{path}/{place}")
        parts = {n: load for n in _Folder(spark, path).names(place) if n.startswith(f"{month}=")}
    rows = frame_of(spark, Version(path, 0, 0, parts, frame.schema.json(), month)).count()
    return load, parts, rows


def _commit(spark: SparkSession, made: Version) -> Version:
    told = {"number": made.number, "rows": made.rows, "parts": made.parts, "shape": made.shape, "month": made.month}
    if not _Folder(spark, made.path).add(f"_versions/{made.number:010d}.json", json.dumps(told)):
        raise Conflict(f"{made.path}: version {made.number} exists")
    return made


def publish(frame: DataFrame, path: str, month: str | None = None) -> Version:
    """Replace the table: readers see the old rows until the new ones are all there."""
    spark = frame.sparkSession
    now = version(spark, path)
    _, parts, rows = _store(frame, path, month)
    return _commit(spark, Version(path, now.number + 1 if now else 0, rows, parts, frame.schema.json(), month))


def key_of(frame: DataFrame, key: str) -> Column:
    """Without a key the row itself is the key, so that the same row again replaces it."""
    whole = F.sha2(F.to_json(F.struct(*sorted(frame.columns))), 256)
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("r"), whole))


def newest(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: the last by `order`, nulls first; among equals the largest row."""
    rank = F.struct(*order, *[c for c in frame.columns if c not in order])
    best = frame.groupBy(key_of(frame, key).alias("_key")).agg(F.max_by(F.struct(*frame.columns), rank).alias("_row"))
    return best.select("_key", "_row.*")


def merge(frame: DataFrame, path: str, key: str = "Numero", month: str = "Ano_Mes",
          order: tuple[str, ...] = ("Encerrado", "Resolvido", "Aberto")) -> Merged:
    """Load rows by key into a table of monthly parts.

    A row replaces the stored row of its key, in whatever month that lies; all other rows
    stay. Only months that gain or lose a row are written again. Of rows of one key in the
    load the newest counts. Rows without a key are kept, the same row once. The counts of
    the load are checked before the new version is there for readers.
    """
    spark = frame.sparkSession
    now = version(spark, path)
    brought = settle(newest(frame, key, list(order)))
    if now is None:
        _, parts, rows = _store(brought.drop("_key"), path, month)
        coming = brought.count()
        _check(path, rows, coming)
        return Merged(_commit(spark, Version(path, 0, rows, parts, frame.schema.json(), month)), 0, 0, coming)
    stored = frame_of(spark, now)
    # Keys and months alone are read of the whole table.
    named = key_of(stored, key)
    keys = brought.select("_key")
    hit = settle(stored.select(named.alias("_key"), month).join(keys, "_key", "left_semi"))
    months = {r[0] for r in hit.select(month).union(brought.select(month)).distinct().collect()}
    touched = [p for p in now.parts if _value(p) in months]
    left = frame_of(spark, now, touched).withColumn("_key", named).join(keys, "_key", "left_anti")
    together = left.unionByName(brought, allowMissingColumns=True).drop("_key")
    _, parts, written = _store(together, path, month)
    replaced, coming = hit.count(), brought.count()
    kept = {p: load for p, load in now.parts.items() if p not in touched}
    made = Version(path, now.number + 1, now.rows - replaced + coming, {**kept, **parts}, together.schema.json(), month)
    untouched = frame_of(spark, Version(path, 0, 0, kept, now.shape, month)).count()
    _check(path, untouched + written, made.rows)
    return Merged(_commit(spark, made), now.rows, replaced, coming)


def _value(part: str) -> str | None:
    value = part.split("=", 1)[1]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def _check(path: str, found: int, expected: int) -> None:
    if found != expected:
        raise LoadMismatch(f"{path}: expected {expected} rows, found {found}")


def clean(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86_400.0) -> int:
    """Delete versions but the newest `keep`, and loads that these do not name. Loads of the
    last `older_than` seconds may belong to a load under way and stay. Returns loads deleted."""
    folder = _Folder(spark, path)
    numbers = sorted(_numbers(folder))
    kept = numbers[-keep:] if keep else []
    named = {load for n in kept for load in version(spark, path, n).parts.values()}
    for n in numbers:
        if n not in kept:
            folder.delete(f"_versions/{n:010d}.json")
    gone = 0
    for name in folder.names("data"):
        load = name.split("=", 1)[-1]
        if name.startswith(f"{LOAD}=") and load not in named and folder.age(f"data/{name}") >= older_than:
            folder.delete(f"data/{name}")
            gone += 1
    return gone
