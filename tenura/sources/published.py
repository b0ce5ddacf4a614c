"""Partitions published whole: written aside, then made current by one small manifest.

Layout of a table: ``<column>=<value>`` folders as Spark writes them, ``_runs/<run>`` for
what a run has written, and ``_manifest/<version>.json``, which names the run of every
published partition. Plain readers skip names that start with an underscore.

A run writes all its partitions into a folder of its own. A new version of the manifest,
put there by one rename that fails if the version exists, makes them current together;
then they are moved to their plain places. Whenever the run is stopped, each partition
is whole: up to the manifest the former one, from then on the new one, which
``read_partitions`` finds in either place. The next run finishes the moves.

Where a rename is a copy, as in object stores, publish with ``settle=False``: partitions stay
in their runs' folders and are read from there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUNS = "_runs"
MANIFEST = "_manifest"
# Versions of the manifest that are kept.
KEPT_VERSIONS = 5


class Folder:
    """A folder on the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._place("").getFileSystem(self._conf)

    def _place(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._system.exists(self._place(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self._system.listStatus(self._place(name))]

    def delete(self, name: str) -> None:
        self._system.delete(self._place(name), True)

    def move(self, name: str, to: str) -> None:
        if not self._system.rename(self._place(name), self._place(to)):
            raise OSError(f"could not move {self.path}/{name} to {to}")

    def modified(self, name: str) -> float:
        """Seconds since 1970."""
        return self._system.getFileStatus(self._place(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._system.open(self._place(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put a whole file there by one rename; False if the name is taken."""
        aside = f"{name}.{uuid.uuid4().hex}"
        stream = self._system.create(self._place(aside), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._system.getUri(), self._conf
        )
        try:
            context.rename(self._place(aside), self._place(name), options)
        except Py4JJavaError:
            self.delete(aside)
            if self.exists(name):
                return False
            raise
        return True


def _versions(folder: Folder) -> list[int]:
    names = folder.names(MANIFEST)
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _version_file(version: int) -> str:
    return f"{MANIFEST}/{version:012d}.json"


def manifest(folder: Folder) -> tuple[int, dict[str, str]]:
    """Latest version, and the run of each published partition folder; 0 if there is none."""
    versions = _versions(folder)
    if not versions:
        return 0, {}
    return versions[-1], json.loads(folder.read(_version_file(versions[-1])))


def _commit(folder: Folder, published: dict[str, str]) -> None:
    """Add partitions to the manifest; another writer's version is read and added to."""
    while True:
        version, current = manifest(folder)
        text = json.dumps({**current, **published}, sort_keys=True)
        if folder.create(_version_file(version + 1), text):
            break
    for old in _versions(folder)[:-KEPT_VERSIONS]:
        folder.delete(_version_file(old))


def _partition_folder(spark: SparkSession, column: str, value: str) -> str:
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog
    return f"{column}={catalog.ExternalCatalogUtils.escapePathName(value)}"


def publish(
    df: DataFrame,
    path: str,
    column: str,
    values: Sequence[str] = (),
    rebalance: bool = False,
    settle: bool = True,
) -> None:
    """Replace the partitions of ``column`` that df has rows of, and those named, at one stroke.

    A named partition without rows is empty from then on; others keep what they held. df
    may be read from the table itself. If writing fails, the table is as before.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    move_published(spark, path)
    run = f"{RUNS}/{uuid.uuid4().hex}"
    rows = df.hint("rebalance", column) if rebalance else df
    rows.write.partitionBy(column).parquet(f"{path}/{run}")
    written = [n for n in folder.names(run) if n.startswith(f"{column}=")]
    nothing = spark.createDataFrame([], df.drop(column).schema)
    for value in values:
        name = _partition_folder(spark, column, value)
        if name not in written:
            nothing.write.parquet(f"{path}/{run}/{name}")
            written.append(name)
    _commit(folder, dict.fromkeys(written, run))
    if settle:
        move_published(spark, path)


def move_published(spark: SparkSession, path: str) -> None:
    """Move published partitions to their plain places, where none was moved yet."""
    folder = Folder(spark, path)
    for name, run in manifest(folder)[1].items():
        if folder.exists(f"{run}/{name}"):
            folder.delete(name)
            folder.move(f"{run}/{name}", name)
            if not any("=" in n for n in folder.names(run)):
                folder.delete(run)


def remove_unpublished(spark: SparkSession, path: str, before: float) -> list[str]:
    """Delete folders of runs last touched before a time (seconds since 1970) of which nothing is published.

    Call it with a time before which no run still writes and no reader of a replaced
    partition still reads. Returns the folders' names.
    """
    folder = Folder(spark, path)
    current = set(manifest(folder)[1].values())
    gone = []
    for name in folder.names(RUNS):
        run = f"{RUNS}/{name}"
        if run not in current and folder.modified(run) < before:
            folder.delete(run)
            gone.append(name)
    return gone


def partition_places(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Folder below ``path`` that holds each partition: in its run, or ``""`` for the plain place."""
    folder = Folder(spark, path)
    places = {n: "" for n in folder.names() if n.startswith(f"{column}=")}
    for name, run in manifest(folder)[1].items():
        places[name] = run if folder.exists(f"{run}/{name}") else ""
    return places


def missing_partitions(
    spark: SparkSession, path: str, column: str, values: Sequence[str]
) -> list[str]:
    """Which of the named partitions were never written."""
    places = partition_places(spark, path, column)
    return [v for v in values if _partition_folder(spark, column, v) not in places]


def read_partitions(
    spark: SparkSession,
    path: str,
    column: str,
    values: Sequence[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Published rows of some partitions (all if none are named), ``column`` as text.

    ``schema`` is that of the rows without ``column``; if it isn't given, it is read from
    one partition. Only the named partitions are listed or scanned.
    """
    places = partition_places(spark, path, column)
    if values is not None:
        named = [_partition_folder(spark, column, v) for v in values]
        places = {n: places[n] for n in named if n in places}
    if schema is None:
        if not places:
            raise ValueError(f"no partition of {column} under {path}")
        name, run = next(iter(places.items()))
        schema = spark.read.parquet("/".join(filter(None, [path, run, name]))).schema
    # Declared, so that a value such as "01" is not read as a number.
    whole = StructType([*schema.fields]).add(column, "string")
    by_root: dict[str, list[str]] = {}
    for name, run in places.items():
        by_root.setdefault("/".join(filter(None, [path, run])), []).append(name)
    parts = [
        spark.read.schema(whole).option("basePath", root).parquet(*(f"{root}/{n}" for n in names))
        for root, names in by_root.items()
    ]
    if not parts:
        return spark.createDataFrame([], whole)
    if values is not None:
        parts = [p.where(F.col(column).isin(*values)) for p in parts]
    return reduce(DataFrame.unionByName, parts)
