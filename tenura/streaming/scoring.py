"""Scoring a stream of prepared subscriber rows with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tenura.plans.models import score
from tenura.schemas import KEY


def read_stream(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Rows of Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def score_stream(
    model: Transformer,
    rows: DataFrame,
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = (KEY,),
    probability: bool = True,
):
    """Score everything available now into a Parquet folder, each row exactly once.

    Scoring keeps no state: a restart continues from the checkpoint.
    """
    return (
        score(model, rows, keys, probability)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
