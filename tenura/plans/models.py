"""Classifiers, tuning, metrics and model storage."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenura.plans.feature_plan import FEATURES, LABEL
from tenura.schemas import KEY
from tenura.sources.shared import materialize

SEED = 17
FOLDS = 3
# Rows of a range of scores.
RANGE_ROWS = 1_000_000

CLASSIFIERS = {"rf": RandomForestClassifier, "lr": LogisticRegression, "gbt": GBTClassifier}

# Tuning grids by classifier.
GRIDS = {
    "rf": {"numTrees": [10, 20, 50], "maxDepth": [5, 10, 20]},
    "lr": {"regParam": [0.01, 0.1, 0.5], "elasticNetParam": [0.0, 0.5, 1.0]},
    "gbt": {"maxIter": [10, 20, 50], "maxDepth": [5, 10, 15]},
}

# Metric names and the evaluator metric behind each.
METRICS = {
    "accuracy": "accuracy",
    "f1": "f1",
    "precision": "weightedPrecision",
    "recall": "weightedRecall",
    "auc": "areaUnderROC",
}


def classifier(
    name: str, features_col: str = FEATURES, label_col: str = LABEL, seed: int = SEED
) -> Estimator:
    """Classifier by short name, with its randomness fixed."""
    if name not in CLASSIFIERS:
        raise ValueError(f"model must be one of {list(CLASSIFIERS)}, not {name!r}")
    estimator = CLASSIFIERS[name](featuresCol=features_col, labelCol=label_col)
    return estimator.setSeed(seed) if estimator.hasParam("seed") else estimator


def param_grid(estimator: Estimator, values: dict[str, list] | None = None) -> list[dict]:
    """Tuning grid bound to the very estimator that will be tuned."""
    if values is None:
        name = next((n for n, c in CLASSIFIERS.items() if type(estimator) is c), None)
        if name is None:
            raise ValueError(f"no grid for {type(estimator).__name__}")
        values = GRIDS[name]
    builder = ParamGridBuilder()
    for param, candidates in values.items():
        builder = builder.addGrid(estimator.getParam(param), candidates)
    return builder.build()


def evaluator(metric: str, label_col: str = LABEL):
    """Spark ML evaluator by short metric name."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {list(METRICS)}, not {metric!r}")
    if metric == "auc":
        return BinaryClassificationEvaluator(labelCol=label_col, metricName=METRICS[metric])
    return MulticlassClassificationEvaluator(labelCol=label_col, metricName=METRICS[metric])


def with_folds(df: DataFrame, folds: int = FOLDS, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Add a fold number taken from the key: the same after a retry or on other partitions."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def tune(
    estimator: Estimator,
    train: DataFrame,
    metric: str,
    grid: list[dict] | None = None,
    folds: int = FOLDS,
    keys: Sequence[str] = (KEY,),
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validate a grid and refit its best point on all of train.

    Boosted trees that differ in their number only are fitted once, see ``staged_scores``.
    """
    labelled = train.where(F.col(estimator.getLabelCol()).isNotNull())
    if isinstance(estimator, GBTClassifier):
        points = param_grid(estimator) if grid is None else grid
        return _tune_boosted(estimator, with_folds(labelled, folds, keys), metric, points, folds, parallelism)
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid(estimator) if grid is None else grid,
        evaluator=evaluator(metric, estimator.getLabelCol()),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(with_folds(labelled, folds, keys))


def staged_scores(
    model: GBTClassificationModel, df: DataFrame, stages: Sequence[int], metric: str
) -> list[float]:
    """The metric of the model's first trees, for each number of trees in ``stages``.

    Boosting adds trees and never changes former ones, so the first 10 trees of a model of 50
    are those of a model of 10 with the same seed. Each tree is evaluated once per row.
    """
    label = model.getLabelCol()
    scored = df.select(F.col(label).alias("_label"), F.col(model.getFeaturesCol()).alias("_features"))
    for i, tree in enumerate(model.trees[: max(stages)]):
        scored = tree.setFeaturesCol("_features").setPredictionCol(f"_tree{i}").transform(scored)
    margin, margins = F.lit(0.0), {}
    for i, weight in enumerate(model.treeWeights[: max(stages)]):
        margin = margin + F.lit(float(weight)) * F.col(f"_tree{i}")
        margins[i + 1] = margin
    wanted = F.array(*(margins[n] for n in stages))
    staged = scored.select(F.col("_label").alias(label), wanted.alias("_margins")).persist()
    found = []
    for place in range(len(stages)):
        at = F.col("_margins")[place]
        found.append(
            evaluator(metric, label).evaluate(
                staged.select(
                    label,
                    array_to_vector(F.array(-at, at)).alias("rawPrediction"),
                    F.when(at > 0, 1.0).otherwise(0.0).alias("prediction"),
                )
            )
        )
    staged.unpersist()
    return found


def _tune_boosted(
    estimator: GBTClassifier, rows: DataFrame, metric: str, grid: list[dict], folds: int, parallelism: int
) -> CrossValidatorModel:
    """One fit per fold and combination of all values but the number of trees."""
    number = estimator.maxIter
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(grid):
        rest = tuple(sorted((p.name, v) for p, v in point.items() if p != number))
        groups.setdefault(rest, []).append(i)
    stages = [point.get(number, estimator.getMaxIter()) for point in grid]
    halves = {
        fold: [rows.where(F.col("fold") != fold).persist(), rows.where(F.col("fold") == fold).persist()]
        for fold in range(folds)
    }

    def run(job: tuple[int, list[int]]) -> tuple[list[int], list[float]]:
        fold, places = job
        train, validation = halves[fold]
        longest = max(places, key=lambda i: stages[i])
        model = estimator.fit(train, grid[longest])
        return places, staged_scores(model, validation, [stages[i] for i in places], metric)

    jobs = [(fold, places) for fold in halves for places in groups.values()]
    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(inheritable_thread_target(run), jobs))
    for half in halves.values():
        for part in half:
            part.unpersist()
    scores: list[list[float]] = [[] for _ in grid]
    for places, found in done:
        for i, value in zip(places, found):
            scores[i].append(value)
    means = [sum(s) / folds for s in scores]
    spread = [math.sqrt(sum((x - m) ** 2 for x in s) / folds) for s, m in zip(scores, means)]
    best = means.index(max(means))
    tuned = CrossValidatorModel(estimator.fit(rows, grid[best]), means, None, spread)
    tuned.set(tuned.estimatorParamMaps, grid)
    return tuned


def grid_scores(tuned: CrossValidatorModel, metric: str) -> DataFrame:
    """Mean cross-validation metric per grid point."""
    spark = SparkSession.active()
    rows = []
    for point, score in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics):
        named = {param.name: float(value) for param, value in point.items()}
        rows.append((named, metric, float(score)))
    return spark.createDataFrame(rows, "params map<string, double>, metric string, score double")


def score(
    model: Transformer, df: DataFrame, keys: Sequence[str] = (KEY,), probability: bool = False
) -> DataFrame:
    """Predictions per key, with the probability of label 1 on request."""
    extra = [vector_to_array("probability")[1].alias("probability")] if probability else []
    return model.transform(df).select(*keys, "prediction", *extra)


def save_model(model: Transformer, path: str, overwrite: bool = False) -> None:
    """Save a fitted model; an existing path is an error unless overwriting."""
    if isinstance(model, CrossValidatorModel):
        model = model.bestModel
    if not isinstance(model, PipelineModel):
        model = PipelineModel([model])
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Accuracy and the label-weighted precision, recall and f1, as one row."""
    n, hit = F.col("n"), F.col("label") == F.col("prediction")
    as_label = F.struct(
        F.col("label").alias("class"), n.alias("support"), F.lit(0).cast("bigint").alias("predicted"),
        F.when(hit, n).otherwise(0).alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
        n.alias("predicted"), F.lit(0).cast("bigint").alias("hits"),
    )
    per_class = (
        confusion(df, label, prediction)
        .select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in ("support", "predicted", "hits")))
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(value):
        return F.try_divide(F.sum(F.col("support") * value), F.sum("support"))

    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
    )


def area_under_roc(
    df: DataFrame,
    label: str = LABEL,
    score_col: str = "probability",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Exact area under the ROC curve as the share of ordered (negative, positive) pairs.

    Rows are combined per distinct score, and scores dealt to ranges in order, one for every
    ``range_rows`` rows, however many there are. The running count of negatives is taken inside
    each range, and the totals of the ranges below are added to it.
    """
    scored = df.select(
        F.col(score_col).cast("double").alias("score"), F.col(label).cast("bigint").alias("y")
    ).where(F.col("score").isNotNull() & F.col("y").isNotNull())
    ranges = max(1, math.ceil(scored.count() / range_rows))
    placed = _prefix_counts(scored, ranges)
    pairs = F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)
    return placed.agg(
        F.try_divide(
            F.sum(pairs), F.sum("pos").cast("double") * F.sum("neg").cast("double")
        ).alias("auc")
    )


def _prefix_counts(scored: DataFrame, ranges: int) -> DataFrame:
    """range, score, pos, neg, neg_below per distinct score; below: of all smaller scores."""
    per_score = scored.groupBy("score").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    dealt = per_score.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id())
    # Written, so that both uses below see the same ranges.
    ranged = materialize(dealt, "scores")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("neg").alias("neg"))
    # One row per range, so one task and a broadcast hold it.
    totals = totals.select("range", F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("neg_before"))
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    placed = ranged.withColumn("neg_inside", below).join(F.broadcast(totals), "range")
    return placed.select(
        "range", "score", "pos", "neg", (F.col("neg_before") + F.col("neg_inside")).alias("neg_below")
    )


def evaluate(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """All five metrics of labelled predictions with probabilities: (metric, value) rows."""
    labelled = predictions.where(F.col(label).isNotNull())
    wide = class_metrics(labelled, label).unpivot(
        [], ["accuracy", "f1", "precision", "recall"], "metric", "value"
    )
    auc = area_under_roc(labelled, label).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return wide.unionByName(auc)
