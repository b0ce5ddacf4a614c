"""Batch jobs that hand tables to each other under one lake folder.

Months have roles by position: the first trains, the ones between evaluate, the last,
for which no following month is known yet, is scored. Every job replaces only the
partitions it makes, all of them at one stroke once they are written, and deletes no input,
so each can be run again, also after it was killed.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.activity import (
    GAP_DAYS,
    churn_labels,
    null_key_counts,
    package_recharge_activity,
    scoring_population,
)
from tenura.operators.features import modelling_dataset
from tenura.plans.feature_plan import FEATURES, LABEL, FeatureRecipe, apply_features, fit_features
from tenura.plans.models import (
    classifier,
    evaluate,
    evaluator,
    load_model,
    param_grid,
    save_model,
    score,
    tune,
)
from tenura.schemas import KEY
from tenura.sources.lake import MONTH, Lake, ingest, load_activity, load_months
from tenura.sources.parquet import is_complete, mark_complete, write_table
from tenura.sources.published import read_partitions
from tenura.sources.shared import materialize

MONTH_KEYS = (MONTH, KEY)


def ingest_job(spark: SparkSession, lake: Lake, months: Sequence[str]) -> None:
    ingest(spark, lake, months)


def label_job(
    spark: SparkSession, lake: Lake, months: Sequence[str], gap_days: int = GAP_DAYS
) -> DataFrame:
    """Labels of every month but the last. Returns the rows of each table without a key."""
    tables = load_activity(spark, lake, months)
    activity = package_recharge_activity(tables["package"], tables["recharge"], MONTH_KEYS)
    labels = churn_labels(activity, months, gap_days)
    write_table(
        labels,
        lake.result_path("label"),
        partition_by=[MONTH],
        rebalance=True,
        partitions=months[:-1],
    )
    return null_key_counts(tables, MONTH_KEYS)


def dataset_job(
    spark: SparkSession, lake: Lake, months: Sequence[str], as_of: datetime.date
) -> DataFrame:
    """Modelling rows of all months, the last one unlabelled, in one pass over the tables.

    Returns the rows of each table without a key, which are left out.
    """
    tables = load_months(spark, lake, months)
    labels = _result(spark, lake, "label", months[:-1])
    newest = [tables[t].where(F.col(MONTH) == months[-1]) for t in ("package", "recharge")]
    population = labels.unionByName(scoring_population(newest, MONTH_KEYS))
    dataset = modelling_dataset(tables, population, as_of, MONTH_KEYS)
    write_table(
        dataset,
        lake.result_path("dataset"),
        partition_by=[MONTH],
        rebalance=True,
        partitions=months,
    )
    return null_key_counts(tables, MONTH_KEYS)


def preprocess_job(
    spark: SparkSession,
    lake: Lake,
    months: Sequence[str],
    recipe: FeatureRecipe | None = None,
    on_invalid: str = "null",
) -> None:
    """Fit the features on the first month, keep the fitted model, transform all months."""
    dataset = _result(spark, lake, "dataset", months)
    fitted = fit_features(dataset.where(F.col(MONTH) == months[0]), recipe, on_invalid)
    save_model(fitted, _features_path(lake), overwrite=True)
    vectors = apply_features(fitted, dataset, (KEY, LABEL, MONTH))
    write_table(
        vectors, lake.result_path("preprocessed"), partition_by=[MONTH], partitions=months
    )


def train_job(
    spark: SparkSession,
    lake: Lake,
    month: str,
    model: str,
    metric: str,
    grid_values: dict[str, list] | None = None,
    overwrite: bool = False,
    parallelism: int = 4,
) -> float | None:
    """Tune a classifier on one month and save it together with the features.

    Returns its metric on that month, or None if the whole model exists already and is not
    to be overwritten. A model that was only partly saved is made anew.
    """
    path = lake.model_path(model, metric)
    if not overwrite and is_complete(spark, path):
        return None
    estimator = classifier(model)
    train = _result(spark, lake, "preprocessed", [month])
    train = train.select(KEY, FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tuned = tune(
            estimator, train, metric, param_grid(estimator, grid_values), parallelism=parallelism
        )
        labelled = tuned.transform(train.where(F.col(LABEL).isNotNull()))
        on_train = evaluator(metric).evaluate(labelled)
    finally:
        train.unpersist()
    features = load_model(_features_path(lake))
    save_model(PipelineModel([*features.stages, tuned.bestModel]), path, overwrite=True)
    mark_complete(spark, path)
    return on_train


def evaluate_job(
    spark: SparkSession, lake: Lake, month: str, model: str, metric: str
) -> DataFrame:
    """All metrics of a saved model on one labelled month, written and returned."""
    rows = _result(spark, lake, "dataset", [month])
    fitted = load_model(lake.model_path(model, metric))
    predictions = score(fitted, rows, (KEY, LABEL), probability=True)
    metrics = evaluate(materialize(predictions, "evaluated"))
    kind = f"metrics/{model}__{metric}"
    write_table(
        metrics.withColumn(MONTH, F.lit(month)),
        lake.result_path(kind),
        partition_by=[MONTH],
        partitions=[month],
    )
    return _result(spark, lake, kind, [month]).select("metric", "value")


def score_job(
    spark: SparkSession, lake: Lake, month: str, model: str, metric: str, probability: bool = False
) -> None:
    """Predictions of a saved model for one month."""
    rows = _result(spark, lake, "dataset", [month])
    fitted = load_model(lake.model_path(model, metric))
    predictions = score(fitted, rows, (KEY,), probability).withColumn(MONTH, F.lit(month))
    write_table(
        predictions,
        lake.result_path(f"predictions/{model}__{metric}"),
        partition_by=[MONTH],
        partitions=[month],
    )


def run_all(
    spark: SparkSession,
    lake: Lake,
    months: Sequence[str],
    as_of: datetime.date,
    model: str = "gbt",
    metric: str = "f1",
    grid_values: dict[str, list] | None = None,
) -> DataFrame:
    """Landing files to predictions; returns the metrics of the second month."""
    ingest_job(spark, lake, months)
    label_job(spark, lake, months)
    dataset_job(spark, lake, months, as_of)
    preprocess_job(spark, lake, months)
    train_job(spark, lake, months[0], model, metric, grid_values)
    metrics = evaluate_job(spark, lake, months[1], model, metric)
    score_job(spark, lake, months[-1], model, metric)
    return metrics


def _features_path(lake: Lake) -> str:
    return f"{lake.root}/models/features"


def _result(
    spark: SparkSession, lake: Lake, kind: str, months: Sequence[str] | None = None
) -> DataFrame:
    """A table made by an earlier job, its month as text even if it looks like a number."""
    return read_partitions(spark, lake.result_path(kind), MONTH, months)
