"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tenura.sources.published import publish

WRITE_MODES = ("append", "overwrite", "ignore", "error")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    partitions: Sequence[str] = (),
) -> None:
    """Write a table. Overwriting a partitioned table replaces only the partitions in df.

    ``partitions`` names values of the only partition column that df stands for: each is
    replaced even if df has no rows of it, and is then there without rows. They are
    published whole, see ``tenura.sources.published``: a write that fails changes nothing.

    ``rebalance`` shuffles rows into files of even size, for results whose tasks each
    hold rows of many table partitions; large table partitions are split over tasks.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    if partitions:
        (column,) = partition_by
        publish(df, path, column, partitions, rebalance)
        return
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _place(spark: SparkSession, path: str):
    """The file system that Spark uses for a path, and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system Spark writes to."""
    system, place = _place(spark, path)
    return system.exists(place)


def mark_complete(spark: SparkSession, path: str, name: str = "_COMPLETE") -> None:
    """Put an empty marker file into a folder whose content is whole."""
    system, place = _place(spark, f"{path}/{name}")
    system.create(place, True).close()


def is_complete(spark: SparkSession, path: str, name: str = "_COMPLETE") -> bool:
    return path_exists(spark, f"{path}/{name}")
