"""Activity per key and month, bucketed by key: labels and bounds without a shuffle.

The table holds one row per key and month, however many rows a key has, so no bucket is
larger than its keys times its months. It is partitioned by month and bucketed and sorted by
key: whatever is grouped by key, or looks at a key's months in order, reads each bucket in one
task and needs no exchange. The one shuffle is paid when a month is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.activity import with_keys
from tenura.schemas import KEY
from tenura.sources.parquet import path_exists

MONTH = "month"
BUCKETS = 64
_COLUMNS = f"{KEY} STRING, first TIMESTAMP, last TIMESTAMP, n BIGINT"


def summarize_activity(activity: DataFrame) -> DataFrame:
    """First and last time and number of rows per month and key, from (month, key, ts) rows."""
    ts = F.col("ts").cast("timestamp")
    return activity.groupBy(KEY, MONTH).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n")
    )


def activity_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """Name of the table under a path in this session's catalog, with all months on disk.

    The number of buckets is part of the folder's name, so sessions that disagree on it can't
    read or write each other's files.
    """
    place = f"{path}/by_{KEY}_{buckets}"
    name = "activity_" + hashlib.md5(place.encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        location = place.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}, {MONTH} STRING) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({MONTH}) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS "
            f"LOCATION '{location}'"
        )
    if path_exists(spark, place):
        spark.catalog.recoverPartitions(name)
    return name


def write_activity(
    activity: DataFrame, path: str, months: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Replace the named months by the summary of (month, key, ts) rows.

    Rows of other months are an error. Each month also gets a row without a key, so a month
    that has no activity any more is replaced as well, and known to be there.
    """
    spark = activity.sparkSession
    name = activity_table(spark, path, buckets)
    known = F.col(MONTH).isin(list(months))
    wrong = F.raise_error(F.concat(F.lit("activity of a month that is not written: "), F.col(MONTH)))
    rows = summarize_activity(with_keys(activity)).withColumn(
        MONTH, F.when(F.coalesce(known, F.lit(False)), F.col(MONTH)).otherwise(wrong)
    )
    marks = spark.createDataFrame([(m,) for m in months], f"{MONTH} string").select(
        F.lit(None).cast("string").alias(KEY), MONTH, *(F.lit(None).alias(c) for c in ("first", "last", "n"))
    )
    columns = [KEY, "first", "last", "n", MONTH]
    written = rows.select(columns).union(marks.select(columns)).repartition(buckets, KEY)
    written.write.mode("overwrite").insertInto(name)


def read_activity(
    spark: SparkSession, path: str, months: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Summaries of some months; a month that was never written raises ValueError."""
    name = activity_table(spark, path, buckets)
    there = {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    absent = [m for m in months if m not in there]
    if absent:
        raise ValueError(f"no activity of months {absent} under {path}")
    return with_keys(spark.table(name).where(F.col(MONTH).isin(list(months))))
