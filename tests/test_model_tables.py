import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.plans.model_tables import probability_sql, score_by_expression, tree_nodes

WALK = """
WITH RECURSIVE placed AS (
    SELECT key, f, tree, weight, node, feature, threshold, left_values, "left", "right", value
    FROM rows CROSS JOIN nodes WHERE node = 0
    UNION ALL
    SELECT p.key, p.f, n.tree, n.weight, n.node, n.feature, n.threshold, n.left_values, n.left, n.right, n.value
    FROM placed p JOIN nodes n ON n.tree = p.tree AND n.node = CASE
        WHEN p.threshold IS NOT NULL AND p.f[p.feature + 1] <= p.threshold THEN p.left
        WHEN p.threshold IS NULL AND list_contains(p.left_values, p.f[p.feature + 1]) THEN p.left
        ELSE p.right END
    WHERE p.feature IS NOT NULL)
SELECT key, {probability} AS p FROM placed WHERE feature IS NULL GROUP BY key"""
PROBABILITY = {
    "forest": "sum(weight * value) / sum(weight)",
    "boosted": "1 / (1 + exp(-2 * sum(weight * value)))",
}


@pytest.fixture(scope="module")
def vectors(spark):
    """Two numbers and two one-hot slots, whose trees split by categories."""
    i = F.col("id")
    raw = spark.range(600).select(
        i.alias("key"), F.round(F.rand(1), 2).alias("x"), (i % 7).cast("double").alias("y"),
        (i % 3).cast("double").alias("c"),
        ((F.rand(3) + (i % 7) / 7 + (i % 3 == 1).cast("int") / 2) > 1).cast("int").alias("label"),
    )
    stages = [OneHotEncoder(inputCols=["c"], outputCols=["o"]),
              VectorAssembler(inputCols=["x", "y", "o"], outputCol="FEATURES")]
    return Pipeline(stages=stages).fit(raw).transform(raw).select("key", "FEATURES", "label").cache()


@pytest.fixture(scope="module", params=["forest", "boosted"])
def fitted(request, vectors):
    shared = {"featuresCol": "FEATURES", "labelCol": "label", "seed": 5}
    made = RandomForestClassifier(numTrees=7, maxDepth=5, **shared)
    if request.param == "boosted":
        made = GBTClassifier(maxIter=8, maxDepth=4, **shared)
    return request.param, made.fit(vectors)


def probabilities(model, vectors):
    p = vector_to_array("probability")[1]
    return dict(model.transform(vectors).select("key", p).collect())


def test_expression_gives_the_models_probability(fitted, vectors):
    _, model = fitted
    found = dict(score_by_expression(model, vectors).select("key", "probability").collect())
    assert found == pytest.approx(probabilities(model, vectors), abs=1e-12)


def test_another_engine_walks_the_nodes(fitted, vectors):
    kind, model = fitted
    nodes = tree_nodes(model).toArrow()
    rows = vectors.select("key", vector_to_array("FEATURES").alias("f")).toArrow()
    con = duckdb.connect()
    con.register("nodes", nodes)
    con.register("rows", rows)
    found = dict(con.execute(WALK.format(probability=PROBABILITY[kind])).fetchall())
    assert found == pytest.approx(probabilities(model, vectors), abs=1e-12)


def test_nodes_form_trees(fitted):
    _, model = fitted
    nodes = [r.asDict() for r in tree_nodes(model).collect()]
    assert {n["tree"] for n in nodes} == set(range(len(model.trees)))
    for tree in range(len(model.trees)):
        own = {n["node"]: n for n in nodes if n["tree"] == tree}
        reached, seek = set(), [0]
        while seek:
            node = own[seek.pop()]
            reached.add(node["node"])
            if node["feature"] is None:
                assert node["value"] is not None and node["left"] is None
            else:
                assert (node["threshold"] is None) != (node["left_values"] is None)
                seek += [node["left"], node["right"]]
        assert reached == set(own)
    assert any(n["left_values"] is not None for n in nodes)


def test_other_models_are_refused(vectors):
    model = LogisticRegression(featuresCol="FEATURES", maxIter=1).fit(vectors)
    with pytest.raises(ValueError, match="no forest"):
        probability_sql(model, "f")
