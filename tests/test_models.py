import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenura.plans.feature_plan import (
    FEATURES,
    FeatureRecipe,
    apply_features,
    fill_stage,
    fit_features,
    fit_modes,
    fit_quantiles,
    log_stage,
    onehot_stages,
    robust_stage,
    scaler_stages,
    spread_features,
)
from tenura.plans.models import (
    GRIDS,
    METRICS,
    _prefix_counts,
    area_under_roc,
    class_metrics,
    classifier,
    evaluate,
    evaluator,
    grid_scores,
    load_model,
    param_grid,
    save_model,
    score,
    tune,
    with_folds,
)
from tenura.streaming.scoring import read_stream, score_stream

RECIPE = FeatureRecipe(
    minmax=("n", "m"), robust=("s",), standard=("age", "balance"), mode=("year",),
    categorical=("kind",),
)


@pytest.fixture(scope="module")
def train(spark):
    i = F.col("id")
    return spark.range(240).select(
        F.concat(F.lit("u"), i).alias("bib_id"),
        (F.hash(i) % 3 + (i % 2) * 2 > 1).cast("int").alias("label"),
        (i % 9).alias("n"),
        (i * 7 % 50 + (i % 2) * 20).cast("double").alias("m"),
        (i * 13 % 31).cast("double").alias("s"),
        F.when(i % 10 > 0, (i * 3 % 130).cast("double")).alias("age"),
        F.when(i % 7 > 0, (i - 20).cast("double")).alias("balance"),
        F.when(i % 3 > 0, (2000 + i % 8).cast("int")).alias("year"),
        F.when(i % 4 == 0, None).when(i % 4 == 1, "x").otherwise("y").alias("kind"),
    ).cache()


@pytest.fixture(scope="module")
def features(train):
    return fit_features(train, RECIPE)


@pytest.fixture(scope="module")
def vectors(train, features):
    return apply_features(features, train).cache()


def scaled(kind, rows, values):
    df = rows("x double", [(v,) for v in values])
    fitted = Pipeline(stages=scaler_stages(["x"], kind, "v")).fit(df)
    return [r[0][0] for r in fitted.transform(df).select(vector_to_array("v")).collect()]


def test_constant_columns(rows):
    assert scaled("minmax", rows, [3.0, 3.0]) == [0.5, 0.5]
    assert scaled("standard", rows, [3.0, 3.0]) == [0.0, 0.0]
    df = rows("x double", [(3.0,), (3.0,)])
    stage = robust_stage(fit_quantiles(df, ranges=["x"])[1])
    assert [r["x_robust"] for r in stage.transform(df).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        scaler_stages(["x"], "robust", "v")


def test_nan_is_filled_like_null(rows):
    nan = float("nan")
    df = rows("x double", [(1.0,), (2.0,), (nan,), (None,), (4.0,)])
    logs = log_stage(["x"])
    logged = logs.transform(df)
    medians, _ = fit_quantiles(logged, ["x_log"])
    assert medians["x_log"] == pytest.approx(math.log(3))
    filled = fill_stage(medians).transform(logged).select("x_log_filled").collect()
    assert sum(r[0] == medians["x_log"] for r in filled) == 3
    raw = fill_stage({"x": 2.0}).transform(df).select("x_filled").collect()
    assert [r[0] for r in raw] == [1.0, 2.0, 2.0, 2.0, 4.0]


def test_modes_and_medians_ignore_null(rows):
    df = rows("s string, i int, x double", [
        (None, None, None), (None, None, None), (None, None, 4.0), ("b'", 2, 1.0), ("a", 1, 2.0)])
    assert fit_modes(df, ["s", "i"]) == {"s": "a", "i": 1}
    assert fit_quantiles(df, ["x"])[0] == {"x": 2.0}
    filled = fill_stage({"s": "o'k\\", "i": 7, "x": 0.5}).transform(df).first()
    assert (filled["s_filled"], filled["i_filled"], filled["x_filled"]) == ("o'k\\", 7, 0.5)
    for fit in (fit_modes, fit_quantiles):
        with pytest.raises(ValueError, match="without any value"):
            fit(df.withColumn("x", F.lit(None).cast("double")), ["x"])


def test_log_stage_caps_and_checks_policy(rows):
    df = rows("age double", [(150.0,), (99.0,), (None,)])
    found = [r["age_log"] for r in log_stage(["age"], {"age": 100.0}).transform(df).collect()]
    assert found == [pytest.approx(math.log(101)), pytest.approx(math.log(100)), None]
    with pytest.raises(ValueError):
        log_stage(["age"], on_invalid="other")


def test_unseen_and_null_categories_are_all_zero(rows):
    train = rows("c string", [("b",), ("a",), ("a",), (None,)])
    model = Pipeline(stages=onehot_stages(["c"])).fit(train)
    other = rows("c string", [("a",), ("b",), ("new",), (None,)])
    encoded = model.transform(other).select("c", vector_to_array("c_onehot").alias("v"))
    assert {r["c"]: r["v"] for r in encoded.collect()} == {
        "a": [1, 0], "b": [0, 1], "new": [0, 0], None: [0, 0]}


def test_features_by_hand(train, vectors):
    pdf = train.toPandas()
    found = spread_features(vectors, 8).toPandas().set_index("bib_id").loc[pdf["bib_id"]]

    def filled(logged):
        logged = np.asarray(logged, dtype=float)
        known = logged[~np.isnan(logged)]
        return np.where(np.isnan(logged), np.quantile(known, 0.5, method="inverted_cdf"), logged)

    def quartile(x, p):
        return np.quantile(x, p, method="inverted_cdf")

    n, m, s = (np.log1p(pdf[c]) for c in ("n", "m", "s"))
    balance = pdf["balance"].where(pdf["balance"] > -1)
    age = filled(np.log1p(pdf["age"].clip(upper=100)))
    balance = filled(np.log1p(balance))
    year = pdf["year"].fillna(pdf["year"].dropna().mode().min())
    expected = [
        (n - n.min()) / (n.max() - n.min()), (m - m.min()) / (m.max() - m.min()),
        s / (quartile(s, 0.75) - quartile(s, 0.25)), age / age.std(ddof=1),
        balance / balance.std(ddof=1), (year - 2000) / 7, pdf["kind"] == "y", pdf["kind"] == "x",
    ]
    for i, values in enumerate(expected):
        assert found[f"f{i:02d}"].to_numpy() == pytest.approx(np.asarray(values, dtype=float))


def test_fit_depends_only_on_train_rows(train, features, vectors):
    again = fit_features(train.repartition(7).orderBy(F.rand(2)), RECIPE, hot_rows=20)
    values = vector_to_array(FEATURES).alias("v")
    left = apply_features(again, train).orderBy("bib_id").select(values).collect()
    right = vectors.orderBy("bib_id").select(values).collect()
    assert [r["v"] for r in left] == [pytest.approx(r["v"]) for r in right]


def test_signed_and_error_policies(train):
    signed = fit_features(train, RECIPE, on_invalid="signed")
    lowest = apply_features(signed, train.orderBy("balance").where("balance IS NOT NULL"))
    assert lowest.select(vector_to_array(FEATURES)[4]).first()[0] < 0
    with pytest.raises(Exception, match="above -1"):
        fit_features(train, RECIPE, on_invalid="error")


def test_grid_is_bound_to_the_estimator(vectors):
    for name, values in GRIDS.items():
        estimator = classifier(name)
        grid = param_grid(estimator)
        assert len(grid) == math.prod(len(v) for v in values.values()) == 9
        assert all(p.parent == estimator.uid for point in grid for p in point)
    estimator = classifier("lr")
    tuned = tune(estimator, vectors, "auc", param_grid(
        estimator, {"regParam": [0.001, 5.0], "elasticNetParam": [0.5]}))
    assert len(set(tuned.avgMetrics)) == 2
    scores = grid_scores(tuned, "auc").collect()
    assert [r["score"] for r in scores] == tuned.avgMetrics
    assert tuned.bestModel.getRegParam() == 0.001


def test_same_seed_gives_same_trees(vectors):
    for name, size in (("rf", {"numTrees": 4}), ("gbt", {"maxIter": 2})):
        runs = []
        for _ in range(2):
            estimator = classifier(name)
            model = estimator.fit(vectors, param_grid(estimator, {k: [v] for k, v in size.items()})[0])
            runs.append(sorted(score(model, vectors, probability=True).collect()))
        assert runs[0] == runs[1]


def test_folds_come_from_the_key(train):
    folds = with_folds(train).select("bib_id", "fold")
    assert sorted(folds.collect()) == sorted(with_folds(train.repartition(5)).select(
        "bib_id", "fold").collect())
    assert {r["fold"] for r in folds.collect()} == {0, 1, 2}


def test_tuning_ignores_unlabelled_rows(vectors):
    unlabelled = vectors.unionByName(vectors.withColumn("label", F.lit(None).cast("int")))
    estimator = classifier("lr")
    grid = param_grid(estimator, {"regParam": [0.1]})
    assert tune(estimator, unlabelled, "f1", grid).avgMetrics == pytest.approx(
        tune(estimator, vectors, "f1", grid).avgMetrics)


@pytest.mark.parametrize("name", ["rf", "lr", "gbt"])
def test_metrics_match_the_evaluators(vectors, name):
    estimator = classifier(name)
    if name != "lr":
        estimator = estimator.setMaxDepth(2)
    raw = estimator.fit(vectors).transform(vectors).cache()
    scored = raw.select("label", "prediction", vector_to_array("probability")[1].alias("probability"))
    found = dict(evaluate(scored).collect())
    assert set(found) == set(METRICS)
    for metric in METRICS:
        if metric != "auc":
            assert found[metric] == pytest.approx(evaluator(metric).evaluate(raw))
    exact = evaluator("auc").setNumBins(0).evaluate(raw)
    assert found["auc"] == pytest.approx(exact)
    assert area_under_roc(scored, range_rows=3).first()["auc"] == pytest.approx(exact)


def test_score_ranges_follow_the_rows(spark):
    """A third of all rows has one score; no range holds many more scores than asked for."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(3)).alias("probability"),
        (F.col("id") % 7 < 3).cast("int").alias("label"),
    )
    scored = rows.select(F.col("probability").alias("score"), F.col("label").cast("long").alias("y"))
    placed = _prefix_counts(scored, 30)
    sizes = [r["count"] for r in placed.groupBy("range").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 3 * 20001 / 30
    below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    plain = placed.withColumn("plain", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    assert plain.where("plain <> neg_below").count() == 0
    few, one = (area_under_roc(rows, range_rows=n).first()["auc"] for n in (1000, 10**9))
    assert few == pytest.approx(one, abs=1e-12)


@pytest.mark.parametrize("metric", ["auc", "f1"])
def test_staged_boosting_equals_separate_fits(vectors, metric):
    estimator = classifier("gbt")
    grid = param_grid(estimator, {"maxIter": [1, 3], "maxDepth": [1]})
    fits = []
    whole = type(estimator)._fit

    def counted(self, df):
        fits.append(self.getMaxIter())
        return whole(self, df)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(estimator), "_fit", counted)
        tuned = tune(estimator, vectors, metric, grid)
    assert sorted(fits[:-1]) == [3] * 3  # once per fold
    separate = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator(metric), numFolds=3, foldCol="fold"
    ).fit(with_folds(vectors))
    assert tuned.avgMetrics == pytest.approx(separate.avgMetrics, abs=1e-9)
    assert tuned.stdMetrics == pytest.approx(separate.stdMetrics, abs=1e-9)
    best = tuned.getEstimatorParamMaps()[tuned.avgMetrics.index(max(tuned.avgMetrics))]
    assert tuned.bestModel.getMaxIter() == best[estimator.maxIter]
    assert tuned.bestModel.getNumTrees == best[estimator.maxIter]


def test_metrics_of_degenerate_predictions(rows):
    one = rows("label int, prediction double, probability double", [(1, 1.0, 0.5), (1, 1.0, 0.7)])
    assert class_metrics(one).first() == (1.0, 1.0, 1.0, 1.0)
    assert area_under_roc(one).first()["auc"] is None
    wrong = rows("label int, prediction double", [(0, 1.0), (1, 0.0)])
    assert class_metrics(wrong).first() == (0.0, 0.0, 0.0, 0.0)
    nothing = class_metrics(wrong.where("false")).first()
    assert nothing["accuracy"] is None


def test_unknown_names():
    with pytest.raises(ValueError):
        classifier("svm")
    with pytest.raises(ValueError):
        evaluator("mse")
    with pytest.raises(ValueError):
        param_grid(Pipeline())


def test_saved_model_scores_alike_in_batch_and_stream(spark, train, features, vectors, tmp_path):
    model = PipelineModel([*features.stages, classifier("lr").fit(vectors)])
    path = str(tmp_path / "model")
    save_model(model, path)
    with pytest.raises(Exception, match="exists"):
        save_model(model, path)
    save_model(model, path, overwrite=True)
    expected = sorted(score(model, train, probability=True).collect())
    loaded = load_model(path)
    assert sorted(score(loaded, train, probability=True).collect()) == expected
    assert score(loaded, train).columns == ["bib_id", "prediction"]

    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first, second = train.where("n < 4"), train.where("n >= 4")
    for batch in (first, second):
        batch.write.mode("append").parquet(source)
        stream = read_stream(spark, source, train.schema)
        score_stream(loaded, stream, sink, state).awaitTermination()
    assert sorted(spark.read.parquet(sink).collect()) == expected


def test_bare_classifier_is_saved_like_a_whole_model(vectors, tmp_path):
    fitted = classifier("lr").fit(vectors)
    save_model(fitted, str(tmp_path / "m"))
    reloaded = load_model(str(tmp_path / "m"))
    assert sorted(score(reloaded, vectors).collect()) == sorted(score(fitted, vectors).collect())
