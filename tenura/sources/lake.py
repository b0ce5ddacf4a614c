"""Monthly tables on disk: one dataset per table, one partition per month."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenura.schemas import TABLES, loaded_schema
from tenura.sources.csv import read_landing_table, rejected_cells
from tenura.sources.parquet import write_table
from tenura.sources.published import missing_partitions, read_partitions

MONTH = "month"
REJECTS = "source STRING, file STRING, column STRING, text STRING"


@dataclass(frozen=True)
class Lake:
    """Places of all tables, models and results under one root folder."""

    root: str
    landing: str = "{root}/landing/{table}_{month}.csv"

    def csv_path(self, table: str, month: str) -> str:
        return self.landing.format(root=self.root, table=table, month=month)

    def table_path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def rejects_path(self, table: str) -> str:
        return f"{self.root}/rejects/{table}"

    def result_path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def model_path(self, model: str, metric: str) -> str:
        return f"{self.root}/models/{model}__{metric}"


def ingest(
    spark: SparkSession, lake: Lake, months: Sequence[str], tables=TABLES, rejects: bool = False
) -> None:
    """CSV to Parquet: one scan-and-write job per table, idempotent per month.

    The months of a table are published together once all are written; a failed ingest leaves
    those that were there. A month whose file has no rows is then there and empty, whatever
    it held before. With ``rejects`` the cells that could not be read are published too,
    before the rows, see ``load_rejects``; that takes a second scan.
    """
    for table in tables:
        if rejects:
            found = [
                rejected_cells(spark, table, lake.csv_path(table, month)).select(
                    F.lit(table).alias("source"), "file", "column", "text", F.lit(month).alias(MONTH)
                )
                for month in months
            ]
            write_table(
                reduce(DataFrame.unionByName, found),
                lake.rejects_path(table),
                partition_by=[MONTH],
                partitions=months,
            )
        monthly = [
            read_landing_table(spark, table, lake.csv_path(table, month)).withColumn(
                MONTH, F.lit(month)
            )
            for month in months
        ]
        write_table(
            reduce(DataFrame.unionByName, monthly),
            lake.table_path(table),
            partition_by=[MONTH],
            partitions=months,
        )


def load_months(
    spark: SparkSession, lake: Lake, months: Sequence[str], tables=TABLES
) -> dict[str, DataFrame]:
    """The named tables for some months, read from where they are published.

    A month of a table that was never ingested raises ValueError; an empty one has no rows.
    """
    loaded = {}
    for table in tables:
        path = lake.table_path(table)
        absent = missing_partitions(spark, path, MONTH, months)
        if absent:
            raise ValueError(f"table {table} has no data for months {absent} under {path}")
        loaded[table] = read_partitions(spark, path, MONTH, months, loaded_schema(table))
    return loaded


def load_rejects(spark: SparkSession, lake: Lake, months: Sequence[str], tables=TABLES) -> DataFrame:
    """Cells that could not be read: source, file, column, text, month.

    A null column stands for a line with too many or too few cells. Months that were ingested
    without ``rejects`` raise ValueError.
    """
    parts = []
    for table in tables:
        path = lake.rejects_path(table)
        absent = missing_partitions(spark, path, MONTH, months)
        if absent:
            raise ValueError(f"no rejects of table {table} for months {absent} under {path}")
        parts.append(read_partitions(spark, path, MONTH, months, StructType.fromDDL(REJECTS)))
    return reduce(DataFrame.unionByName, parts)


def load_activity(spark: SparkSession, lake: Lake, months: Sequence[str]) -> dict[str, DataFrame]:
    """Package and recharge rows, the two tables that labels are made from."""
    return load_months(spark, lake, months, tables=["package", "recharge"])
