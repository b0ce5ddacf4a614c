"""Tree models as relations: their nodes as a table, and as one column expression.

Any engine that can join or evaluate CASE gets the same probabilities from them, without
the model's own code: those of a forest are the mean of its leaves' shares, those of boosted
trees the logistic of twice the weighted sum of their leaves.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.plans.feature_plan import FEATURES
from tenura.sources.shared import new_path

ENSEMBLES = {RandomForestClassificationModel: "forest", GBTClassificationModel: "boosted"}


def ensemble_of(model: Transformer) -> Transformer:
    """The tree ensemble of a model, or of the last stage of a pipeline."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if type(model) not in ENSEMBLES:
        raise ValueError(f"{type(model).__name__} is no forest and no boosted trees")
    return model


def tree_nodes(model: Transformer) -> DataFrame:
    """One row per node: tree, weight, node, feature, threshold, left_values, left, right, value.

    A row goes to ``left`` if its feature is at most ``threshold``, or, for a feature of
    categories, among ``left_values``; else to ``right``. Leaves have no feature. ``value``
    is what a leaf gives: the share of label 1 in a forest, the tree's prediction if boosted.
    Trees and nodes count from 0, and node 0 is a tree's root.
    """
    model = ensemble_of(model)
    spark = SparkSession.active()
    path = new_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata")
    tree, _, weight = weights.columns
    weights = weights.select(F.col(tree).alias("tree"), F.col(weight).alias("weight"))
    if isinstance(model, RandomForestClassificationModel):
        value = "impurityStats[1] / aggregate(impurityStats, 0D, (x, y) -> x + y)"
    else:
        value = "prediction"
    inner = "leftChild >= 0"
    ordered = "split.numCategories < 0"
    flat = nodes.select(F.col(nodes.columns[0]).alias("tree"), f"{nodes.columns[1]}.*")
    return flat.join(F.broadcast(weights), "tree").selectExpr(
        "tree", "weight", "id AS node",
        f"CASE WHEN {inner} THEN split.featureIndex END AS feature",
        f"CASE WHEN {inner} AND {ordered} THEN split.leftCategoriesOrThreshold[0] END AS threshold",
        f"CASE WHEN {inner} AND NOT ({ordered}) THEN split.leftCategoriesOrThreshold END AS left_values",
        f"CASE WHEN {inner} THEN leftChild END AS left",
        f"CASE WHEN {inner} THEN rightChild END AS right",
        f"CASE WHEN NOT ({inner}) THEN {value} END AS value",
    )


def probability_sql(model: Transformer, values: str) -> str:
    """The whole ensemble as SQL over an array column of features."""
    kind = ENSEMBLES[type(ensemble_of(model))]
    trees: dict[int, dict[int, object]] = {}
    weights = {}
    for row in tree_nodes(model).collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row
        weights[row["tree"]] = row["weight"]

    def number(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"

    def branch(tree: dict, node: int) -> str:
        row = tree[node]
        if row["feature"] is None:
            return number(row["value"])
        feature = f"{values}[{row['feature']}]"
        if row["threshold"] is not None:
            goes_left = f"{feature} <= {number(row['threshold'])}"
        else:
            goes_left = f"{feature} IN ({', '.join(map(number, row['left_values'])) or 'NULL'})"
        return f"CASE WHEN {goes_left} THEN {branch(tree, row['left'])} ELSE {branch(tree, row['right'])} END"

    total = " + ".join(f"{number(weights[t])} * {branch(trees[t], 0)}" for t in sorted(trees))
    if kind == "forest":
        return f"({total}) / {number(sum(weights.values()))}"
    return f"1 / (1 + exp(-2 * ({total})))"


def score_by_expression(
    model: Transformer, vectors: DataFrame, features_col: str = FEATURES
) -> DataFrame:
    """Rows with the probability of label 1 from the model's column expression."""
    spread = vectors.withColumn("_values", vector_to_array(features_col))
    return spread.withColumn("probability", F.expr(probability_sql(model, "_values"))).drop("_values")
