"""Fitted features, classifiers, metrics and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.catalog.features import (
    ALL_TABLES,
    DATASET_SQL,
    EXACT_USER_SQL,
    PERIOD_AGGREGATES,
    aggregate_sql,
    dataset,
    dataset_sql,
    split_dataset,
    split_sql,
)
from tenura.catalog.registry import bound_sql, query
from tenura.catalog.sources import build_lake
from tenura.operators.features import FEATURE_SETS, aggregate_features, user_attributes
from tenura.plans.feature_plan import (
    FEATURES,
    apply_features,
    fill_stage,
    fit_features,
    fit_modes,
    fit_quantiles,
    onehot_stages,
    robust_stage,
    scaler_stages,
    spread_features,
)
from tenura.plans.jobs import (
    dataset_job,
    evaluate_job,
    label_job,
    preprocess_job,
    score_job,
    train_job,
)
from tenura.plans.model_tables import score_by_expression
from tenura.plans.models import (
    area_under_roc,
    class_metrics,
    classifier,
    evaluate,
    grid_scores,
    load_model,
    param_grid,
    save_model,
    score,
    tune,
)
from tenura.schemas import AMOUNT_FEATURES, USAGE_FEATURES
from tenura.sources.bindings import AS_OF, StarSchema
from tenura.sources.lake import MONTH, load_months
from tenura.sources.parquet import read_table, write_table
from tenura.sources.shared import materialize, new_path
from tenura.streaming.scoring import read_stream, score_stream

RECHARGES = ["CountRecharge", "MedianRechargeAmount"]
RECHARGE_SQL = f"recharges AS ({aggregate_sql('recharge')})"


def recharges(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate_features(StarSchema(spark, sf).recharge(), FEATURE_SETS["recharge"])


def users(spark: SparkSession, sf: str) -> DataFrame:
    return user_attributes(StarSchema(spark, sf).user(), AS_OF)


def _vector(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    values = vector_to_array(vector)
    return df.select("bib_id", *(F.round(values[i], 6).alias(n) for i, n in enumerate(names)))


@query(
    "m2_assembled_vector",
    bound_sql(
        """SELECT bib_id, CAST("CountRecharge" AS DOUBLE) AS "CountRecharge",
                  round("MedianRechargeAmount", 6) AS "MedianRechargeAmount" FROM recharges""",
        "recharge",
        more=RECHARGE_SQL,
    ),
)
def assembled(spark, sf):
    vector = VectorAssembler(inputCols=RECHARGES, outputCol="v").transform(recharges(spark, sf))
    return _vector(vector, "v", RECHARGES)


@query(
    "m3_scaled_by_train_fit",
    bound_sql(
        """SELECT bib_id, round((v - lo) / (hi - lo), 6) AS scaled
           FROM (SELECT bib_id, median(recharge_value_amt) AS v FROM recharge
                 WHERE recharge_dt >= TIMESTAMP '1998-01-01' GROUP BY bib_id),
                (SELECT min(v) AS lo, max(v) AS hi FROM (
                     SELECT median(recharge_value_amt) AS v FROM recharge
                     WHERE recharge_dt < TIMESTAMP '1998-01-01' GROUP BY bib_id))""",
        "recharge",
    ),
)
def scaled_by_train(spark, sf):
    """Fitted before 1998, applied from 1998 on, where values may leave [0, 1]."""
    rows = StarSchema(spark, sf).recharge()
    middle = F.lit("1998-01-01").cast("timestamp_ntz")
    wanted = FEATURE_SETS["recharge"]
    train = aggregate_features(rows.where(F.col("recharge_dt") < middle), wanted)
    later = aggregate_features(rows.where(F.col("recharge_dt") >= middle), wanted)
    fitted = Pipeline(stages=scaler_stages(["MedianRechargeAmount"], "minmax", "v")).fit(train)
    return _vector(fitted.transform(later), "v", ["scaled"])


@query(
    "m4_minmax_scale",
    bound_sql(
        "SELECT bib_id, "
        + ", ".join(
            f'round(("{c}" - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()), 6)'
            f' AS "{c}"'
            for c in RECHARGES
        )
        + " FROM recharges",
        "recharge",
        more=RECHARGE_SQL,
    ),
)
def minmax(spark, sf):
    rows = recharges(spark, sf)
    fitted = Pipeline(stages=scaler_stages(RECHARGES, "minmax", "v")).fit(rows)
    return _vector(fitted.transform(rows), "v", RECHARGES)


@query(
    "m5_robust_scale",
    bound_sql(
        "SELECT bib_id, "
        + ", ".join(
            f'round("{c}" / (SELECT quantile_disc("{c}", 0.75) - quantile_disc("{c}", 0.25)'
            f' FROM recharges), 6) AS "{c}"'
            for c in RECHARGES
        )
        + " FROM recharges",
        "recharge",
        more=RECHARGE_SQL,
    ),
)
def robust(spark, sf):
    rows = recharges(spark, sf)
    scaled = robust_stage(fit_quantiles(rows, ranges=RECHARGES)[1]).transform(rows)
    return scaled.select("bib_id", *(F.round(f"{c}_robust", 6).alias(c) for c in RECHARGES))


@query(
    "m6_standard_scale",
    bound_sql(
        "SELECT bib_id, "
        + ", ".join(f'round("{c}" / stddev_samp("{c}") OVER (), 6) AS "{c}"' for c in RECHARGES)
        + " FROM recharges",
        "recharge",
        more=RECHARGE_SQL,
    ),
)
def standard(spark, sf):
    rows = recharges(spark, sf)
    fitted = Pipeline(stages=scaler_stages(RECHARGES, "standard", "v")).fit(rows)
    return _vector(fitted.transform(rows), "v", RECHARGES)


@query(
    "m7_median_fill",
    bound_sql(
        """SELECT bib_id, coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM b)) AS balance
           FROM b""",
        "subscriber",
        more="""b AS (SELECT bib_id, CASE WHEN gender_v IS NOT NULL THEN account_balance END
                      AS balance FROM subscriber)""",
    ),
)
def median_filled(spark, sf):
    balance = F.when(F.col("gender_v").isNotNull(), F.col("account_balance"))
    rows = StarSchema(spark, sf).user().select("bib_id", balance.alias("balance"))
    filled = fill_stage(fit_quantiles(rows, medians=["balance"])[0]).transform(rows)
    return filled.select("bib_id", F.col("balance_filled").alias("balance"))


@query(
    "m8_mode_fill",
    bound_sql(
        """SELECT bib_id, coalesce(gender_v, (SELECT gender_v FROM subscriber
                      WHERE gender_v IS NOT NULL GROUP BY ALL
                      ORDER BY count(*) DESC, gender_v LIMIT 1)) AS gender_v,
                  CAST(coalesce(year(registration_date_d), (SELECT year(registration_date_d)
                      FROM subscriber WHERE registration_date_d IS NOT NULL GROUP BY ALL
                      ORDER BY count(*) DESC, year(registration_date_d) LIMIT 1)) AS INTEGER)
                      AS registration_year
           FROM subscriber""",
        "subscriber",
    ),
)
def mode_filled(spark, sf):
    cols = ["gender_v", "registration_year"]
    rows = users(spark, sf).select("bib_id", *cols)
    filled = fill_stage(fit_modes(rows, cols)).transform(rows)
    return filled.select("bib_id", *(F.col(f"{c}_filled").alias(c) for c in cols))


CATEGORIES = {"contract_type_v": 5, "gender_v": 2, "ability_status": 2}


def _ranked(table: str) -> str:
    """Categories by falling frequency, one table expression per column."""
    return ", ".join(
        f"""{c}_rank AS (SELECT {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) AS r
            FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in CATEGORIES
    )


def _slots(first: int = 0) -> list[str]:
    """One-hot columns named from f<first> on."""
    slots = [(c, r) for c, size in CATEGORIES.items() for r in range(1, size + 1)]
    return [
        f"""CASE WHEN {c} = (SELECT value FROM {c}_rank WHERE r = {r}) THEN 1.0::DOUBLE
            ELSE 0.0::DOUBLE END AS f{first + i:02d}"""
        for i, (c, r) in enumerate(slots)
    ]


@query(
    "m9_onehot",
    bound_sql(
        f"SELECT bib_id, {', '.join(_slots())} FROM subscriber",
        "subscriber",
        more=_ranked("subscriber"),
    ),
)
def onehot(spark, sf):
    rows = StarSchema(spark, sf).user().select("bib_id", *CATEGORIES)
    encode = [
        *onehot_stages(list(CATEGORIES)),
        VectorAssembler(inputCols=[f"{c}_onehot" for c in CATEGORIES], outputCol=FEATURES),
    ]
    encoded = Pipeline(stages=encode).fit(rows).transform(rows)
    return spread_features(encoded.select("bib_id", FEATURES), 9)


def _features_sql(data: str, train: str, passed: str, *tables: str) -> str:
    """The whole recipe in vector order: fitted on the train rows of data, applied to all."""
    logs = [f'CASE WHEN "{c}" > -1 THEN ln(1 + "{c}") END AS "{c}"'
            for c in AMOUNT_FEATURES + USAGE_FEATURES]
    logs.append("CASE WHEN age > 100 THEN ln(101) WHEN age > -1 THEN ln(1 + age) END AS age")
    logs.append("CASE WHEN account_balance > -1 THEN ln(1 + account_balance) END"
                " AS account_balance")
    numeric = [*AMOUNT_FEATURES, *USAGE_FEATURES, "age", "account_balance"]
    fills = [f'coalesce("{c}", (SELECT quantile_disc("{c}", 0.5) FROM train_logs)) AS "{c}"'
             for c in numeric]
    fills.append("""coalesce(registration_year, (SELECT registration_year FROM train_logs
        WHERE registration_year IS NOT NULL GROUP BY ALL
        ORDER BY count(*) DESC, registration_year LIMIT 1)) AS registration_year""")
    passed = f"{passed}, {', '.join(CATEGORIES)}"

    def of_train(expression):
        return f"(SELECT {expression} FROM train_filled)"

    def minmax_sql(c):
        low, high = of_train(f'min("{c}")'), of_train(f'max("{c}")')
        return f'CASE WHEN {low} = {high} THEN 0.5 ELSE ("{c}" - {low}) / ({high} - {low}) END'

    def robust_sql(c):
        width = f'(SELECT quantile_disc("{c}", 0.75) - quantile_disc("{c}", 0.25) FROM train_logs)'
        return f'CASE WHEN {width} = 0 THEN 0 ELSE "{c}" / {width} END'

    def standard_sql(c):
        deviation = of_train(f'stddev_samp("{c}")')
        # A constant column scales to 0, as FIXTURES.md 3.2 has it.
        return f'CASE WHEN {deviation} = 0 THEN 0 ELSE "{c}" / {deviation} END'

    values = [*map(minmax_sql, AMOUNT_FEATURES), *map(robust_sql, USAGE_FEATURES),
              standard_sql("age"), standard_sql("account_balance"),
              minmax_sql("registration_year")]
    named = [f"CAST(round({v}, 6) AS DOUBLE) AS f{i:02d}" for i, v in enumerate(values)]
    kept = passed.removesuffix(f", {', '.join(CATEGORIES)}")
    return bound_sql(
        f"SELECT {kept}, {', '.join(named + _slots(len(named)))} FROM filled",
        *tables,
        more=f"""data AS MATERIALIZED ({data}), train AS (SELECT * FROM data WHERE {train}),
            logs AS (SELECT {passed}, registration_year, {', '.join(logs)} FROM data),
            train_logs AS MATERIALIZED (SELECT * FROM logs WHERE {train}),
            filled AS (SELECT {passed}, {', '.join(fills)} FROM logs),
            train_filled AS MATERIALIZED (SELECT * FROM filled WHERE {train}),
            {_ranked('train')}""",
    )


LABELLED_FEATURES_SQL = _features_sql(
    dataset_sql("label", PERIOD_AGGREGATES, EXACT_USER_SQL),
    "true",
    "bib_id, label",
    *ALL_TABLES,
    "activity",
    "label",
)
# Quarters of 1996 by the split they serve as.
QUARTERS = {"train": "1996Q1", "eval": "1996Q2", "test": "1996Q3"}
SPLIT_FEATURES_SQL = _features_sql(
    "SELECT * EXCLUDE split, CASE split "
    + " ".join(f"WHEN '{s}' THEN '{q}'" for s, q in QUARTERS.items())
    + f" END AS month FROM ({split_sql(EXACT_USER_SQL)})",
    "month = '1996Q1'",
    "month, bib_id, label",
    *ALL_TABLES,
    "activity",
)


@query("m10_m11_fitted_features", LABELLED_FEATURES_SQL)
def fitted_features(spark, sf):
    rows = materialize(dataset(spark, sf), "dataset")
    vectors = apply_features(fit_features(rows), rows)
    return spread_features(vectors, 25, digits=6)


def _trained(spark, sf, name="lr"):
    """Fitted features and classifier of the labelled dataset, and the dataset."""
    rows = materialize(dataset(spark, sf), "dataset")
    features = fit_features(rows)
    vectors = materialize(apply_features(features, rows), "vectors")
    return PipelineModel([*features.stages, classifier(name).fit(vectors)]), rows


# What must hold for every subscriber of the label query.
FACTS_SQL = bound_sql(
    "SELECT bib_id, 1 AS in_range, 1 AS by_half, 1 AS of_classes FROM label",
    "package", "recharge", "activity", "label",
)


def _facts(scored: DataFrame) -> DataFrame:
    """Per subscriber: probability in [0, 1], prediction by its half, prediction 0 or 1."""
    p, found = F.col("probability"), F.col("prediction")
    return scored.select(
        "bib_id",
        p.between(0, 1).cast("int").alias("in_range"),
        (found == F.when(p > 0.5, 1.0).otherwise(0.0)).cast("int").alias("by_half"),
        found.isin(0.0, 1.0).cast("int").alias("of_classes"),
    )


def _scored(name):
    def run(spark, sf):
        model, rows = _trained(spark, sf, name)
        return _facts(score(model, rows, probability=True))

    return run


query("k1_random_forest", FACTS_SQL)(_scored("rf"))
query("k2_logistic_regression", FACTS_SQL)(_scored("lr"))
query("k3_gradient_boosted_trees", FACTS_SQL)(_scored("gbt"))


def _as_expression(name):
    def run(spark, sf):
        """Per subscriber, whether the exported trees give the model's own probability."""
        rows = materialize(dataset(spark, sf), "dataset")
        vectors = materialize(apply_features(fit_features(rows), rows), "vectors")
        model = classifier(name).fit(vectors)
        exported = score_by_expression(model, vectors)
        both = model.transform(exported.withColumnRenamed("probability", "exported"))
        near = F.abs(F.col("exported") - vector_to_array("probability")[1]) < 1e-9
        return both.select("bib_id", near.cast("int").alias("same"))

    return run


SAME_SQL = bound_sql(
    "SELECT bib_id, 1 AS same FROM label", "package", "recharge", "activity", "label"
)
query("k1_forest_as_expression", SAME_SQL)(_as_expression("rf"))
query("k3_boosted_trees_as_expression", SAME_SQL)(_as_expression("gbt"))


@query("k2_score_equations", "SELECT 25 AS slots, 25 AS near_zero")
def score_equations(spark, sf):
    """Without a penalty, sums of (probability - label) times each feature vanish at the fit."""
    rows = materialize(dataset(spark, sf), "dataset")
    vectors = materialize(apply_features(fit_features(rows), rows), "vectors")
    fitted = classifier("lr").setMaxIter(500).setTol(1e-12).fit(vectors)
    wide = spread_features(
        fitted.transform(vectors).select(
            "label", "FEATURES", vector_to_array("probability")[1].alias("p")
        ), 25,
    )
    gap = F.col("p") - F.col("label")
    names = [f"f{i:02d}" for i in range(25)]
    sums = wide.agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(gap * F.col(c)).alias(c) for c in names)
    )
    near = sum(((F.abs(c) < 1e-3 * F.col("n")).cast("int") for c in map(F.col, names)), F.lit(0))
    return sums.select(F.lit(25).alias("slots"), near.alias("near_zero"))


# Labelled rows that a tuning query fits on at most; the grid is never cut.
TUNED_ROWS = 200
GRID_SQL = "SELECT 9 AS points, 9 AS in_range, 9 AS named, 1 AS best_is_largest"


def _tuned(name):
    def run(spark, sf):
        """The whole grid over three folds: its points and scores, and which one was refitted."""
        rows = materialize(dataset(spark, sf), "dataset")
        vectors = apply_features(fit_features(rows), rows)
        vectors = materialize(vectors.orderBy(F.xxhash64("bib_id")).limit(TUNED_ROWS), "vectors")
        estimator = classifier(name)
        tuned = tune(estimator, vectors, "auc", param_grid(estimator))
        scores = grid_scores(tuned, "auc")
        best = max(tuned.avgMetrics)
        chosen = tuned.getEstimatorParamMaps()[tuned.avgMetrics.index(best)]
        used = all(
            tuned.bestModel.getOrDefault(tuned.bestModel.getParam(p.name)) == v
            for p, v in chosen.items()
        )
        return scores.agg(
            F.count(F.lit(1)).cast("int").alias("points"),
            F.count_if(F.col("score").between(0, 1)).cast("int").alias("in_range"),
            F.count_distinct(F.to_json("params")).cast("int").alias("named"),
            F.lit(int(used)).alias("best_is_largest"),
        )

    return run


query("k4_k5_tuned_grid", GRID_SQL)(_tuned("lr"))
query("k4_k5_tuned_grid_of_forests", GRID_SQL)(_tuned("rf"))
query("k4_k5_tuned_grid_of_boosted_trees", GRID_SQL)(_tuned("gbt"))


RULE = """rule AS (SELECT label, CASE WHEN "CountPackage" < 2 THEN 1 ELSE 0 END AS prediction,
                          "CountRecharge" + "MedianPackageAmount" / 1e6 AS probability FROM data)"""


def _rule(spark, sf):
    """A rule and a score over the labelled dataset."""
    return dataset(spark, sf).select(
        "label",
        F.when(F.col("CountPackage") < 2, 1).otherwise(0).alias("prediction"),
        (F.col("CountRecharge") + F.col("MedianPackageAmount") / 1e6).alias("probability"),
    )


@query(
    "k6_class_metrics",
    bound_sql(
        """SELECT round(sum(tp) / sum(support), 6) AS accuracy,
                  round(sum(support * coalesce(2 * tp / (support + predicted), 0)) / sum(support), 6)
                      AS f1,
                  round(sum(support * coalesce(tp / nullif(predicted, 0), 0)) / sum(support), 6)
                      AS "precision",
                  round(sum(support * coalesce(tp / nullif(support, 0), 0)) / sum(support), 6)
                      AS recall
           FROM (SELECT k, (SELECT count(*) FROM rule WHERE label = k)::DOUBLE AS support,
                        (SELECT count(*) FROM rule WHERE prediction = k)::DOUBLE AS predicted,
                        (SELECT count(*) FROM rule WHERE label = k AND prediction = k)::DOUBLE AS tp
                 FROM (SELECT unnest([0, 1]) AS k))""",
        more=f"data AS ({DATASET_SQL}), {RULE}",
    ),
)
def rule_metrics(spark, sf):
    found = class_metrics(_rule(spark, sf))
    return found.select(*(F.round(c, 6).alias(c) for c in found.columns))


@query(
    "k6_area_under_roc",
    bound_sql(
        """SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc
           FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN
                           UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                 FROM (SELECT probability, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
                       FROM rule GROUP BY probability))""",
        more=f"data AS ({DATASET_SQL}), {RULE}",
    ),
)
def rule_auc(spark, sf):
    rows = materialize(_rule(spark, sf), "rule")
    return area_under_roc(rows).select(F.round("auc", 6).alias("auc"))


# Metrics in plain SQL over predictions.
PLAIN_METRICS = """
    WITH k AS (SELECT CAST(c AS DOUBLE) AS c FROM VALUES (0), (1) AS t(c)),
    s AS (SELECT c, count_if(label = c) AS support, count_if(prediction = c) AS predicted,
                 count_if(label = c AND prediction = c) AS tp FROM k CROSS JOIN {rows} GROUP BY c),
    r AS (SELECT label, avg(rank) AS rank, count(*) AS n FROM (
            SELECT label, avg(n) OVER (PARTITION BY probability) AS rank FROM (
                SELECT label, probability, row_number() OVER (ORDER BY probability) AS n
                FROM {rows})) GROUP BY label)
    SELECT 'accuracy' AS metric, sum(tp) / sum(support) AS plain FROM s
    UNION ALL SELECT 'f1', sum(support * coalesce(2 * tp / (support + predicted), 0)) / sum(support) FROM s
    UNION ALL SELECT 'precision', sum(support * coalesce(tp / nullif(predicted, 0), 0)) / sum(support) FROM s
    UNION ALL SELECT 'recall', sum(support * coalesce(tp / nullif(support, 0), 0)) / sum(support) FROM s
    UNION ALL SELECT 'auc', (max(CASE WHEN label = 1 THEN rank END)
                             - (max(CASE WHEN label = 1 THEN n END) + 1) / 2)
                            / max(CASE WHEN label = 0 THEN n END) FROM r"""
METRICS_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, 1 AS equal" for m in ("accuracy", "f1", "precision", "recall", "auc")
)


def _equal_to_plain(metrics: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per metric, whether it is what plain SQL gives for the predictions."""
    plain = predictions.sparkSession.sql(PLAIN_METRICS.format(rows="{rows}"), rows=predictions)
    near = F.abs(F.col("value") - F.col("plain")) < 1e-9
    return metrics.join(plain, "metric", "full").select("metric", near.cast("int").alias("equal"))


@query("k7_evaluated_model", METRICS_SQL)
def evaluated(spark, sf):
    """Fitted on the train quarter, measured on the next one."""
    rows = materialize(split_dataset(spark, sf), "splits")
    train = rows.where(F.col("split") == "train")
    features = fit_features(train)
    vectors = materialize(apply_features(features, train), "vectors")
    model = PipelineModel([*features.stages, classifier("lr").fit(vectors)])
    later = rows.where(F.col("split") == "eval")
    predictions = score(model, later, ("bib_id", "label"), probability=True)
    predictions = materialize(predictions, "evaluated")
    return _equal_to_plain(evaluate(predictions), predictions)


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whether two sets of predictions agree, per subscriber of either."""
    joined = left.alias("a").join(right.alias("b"), "bib_id", "full")
    same = F.col("a.probability").eqNullSafe(F.col("b.probability"))
    return joined.select("bib_id", F.when(same, 1).otherwise(0).alias("same"))


@query("s8_s9_saved_model_scores_alike", SAME_SQL)
def saved_model(spark, sf):
    model, rows = _trained(spark, sf)
    path = new_path(spark, "model")
    save_model(model, path)
    reloaded = score(load_model(path), rows, probability=True)
    return _same(score(model, rows, probability=True), reloaded)


@query(
    "s10_predictions_sink",
    bound_sql(
        "SELECT count(*) AS n_rows, count(DISTINCT bib_id) AS subscribers FROM label",
        "package",
        "recharge",
        "activity",
        "label",
    ),
)
def predictions_sink(spark, sf):
    model, rows = _trained(spark, sf)
    path = new_path(spark, "predictions")
    write_table(score(model, rows), path)
    per_key = read_table(spark, path).groupBy("bib_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count("bib_id").alias("subscribers"))


@query(
    "k10_scored_subscribers",
    bound_sql(
        """SELECT DISTINCT bib_id, 1 AS in_range, 1 AS by_half, 1 AS of_classes FROM activity
           WHERE ts >= TIMESTAMP '1996-07-01' AND ts < TIMESTAMP '1996-10-01'""",
        "package", "recharge", "activity",
    ),
)
def scored(spark, sf):
    """Fitted on the train quarter, applied to the raw rows of the unlabelled one."""
    rows = materialize(split_dataset(spark, sf), "splits")
    train = rows.where(F.col("split") == "train")
    features = fit_features(train)
    vectors = materialize(apply_features(features, train), "vectors")
    model = PipelineModel([*features.stages, classifier("rf").fit(vectors)])
    return _facts(score(model, rows.where(F.col("split") == "test"), probability=True))


def _quarters(spark: SparkSession, sf: str):
    """A lake of quarters with labels and datasets of three of them."""
    lake = build_lake(
        spark, sf, month=lambda c: F.concat(F.year(c), F.lit("Q"), F.quarter(c))
    )
    months = list(QUARTERS.values())
    # Undated tables hold the same rows in every quarter.
    for table in ("cdr", "user"):
        rows = load_months(spark, lake, ["all"], [table])[table].drop(MONTH)
        each = rows.select("*", F.explode(F.array(*map(F.lit, months))).alias(MONTH))
        write_table(each, lake.table_path(table), partition_by=[MONTH], rebalance=True)
    label_job(spark, lake, months)
    dataset_job(spark, lake, months, AS_OF)
    preprocess_job(spark, lake, months)
    return lake, months


@query("k12_preprocess_job", SPLIT_FEATURES_SQL)
def preprocessed(spark, sf):
    lake, _ = _quarters(spark, sf)
    vectors = read_table(spark, lake.result_path("preprocessed"))
    return spread_features(vectors, 25, digits=6)


JOBS_SQL = bound_sql(
    f"""SELECT DISTINCT bib_id, 1 AS same, 1 AS trained, 5 AS equal_metrics FROM activity
        WHERE ts >= TIMESTAMP '1996-07-01' AND ts < TIMESTAMP '1996-10-01'""",
    "package", "recharge", "activity",
)


@query("k8_k9_k11_train_evaluate_score_jobs", JOBS_SQL)
def train_evaluate_score(spark, sf):
    """Predictions of the last quarter against batch scores, and checks of the metrics."""
    lake, months = _quarters(spark, sf)
    on_train = train_job(spark, lake, months[0], "lr", "f1")
    metrics = evaluate_job(spark, lake, months[1], "lr", "f1")
    score_job(spark, lake, months[2], "lr", "f1")
    rows = read_table(spark, lake.result_path("dataset"))
    model = load_model(lake.model_path("lr", "f1"))
    later = rows.where(F.col(MONTH) == months[1])
    labelled = materialize(score(model, later, ("bib_id", "label"), probability=True), "evaluated")
    equal = _equal_to_plain(metrics, labelled).agg(F.sum("equal")).first()[0]
    batch = score(model, rows.where(F.col(MONTH) == months[2]), probability=True)
    written = read_table(spark, lake.result_path("predictions/lr__f1"))
    joined = written.alias("a").join(batch.alias("b"), "bib_id", "full")
    same = F.col("a.prediction").eqNullSafe(F.col("b.prediction"))
    return joined.select(
        "bib_id", same.cast("int").alias("same"),
        F.lit(int(on_train is not None and 0 <= on_train <= 1)).alias("trained"),
        F.lit(int(equal)).alias("equal_metrics"),
    )


@query("z1_stream_scores_like_batch", SAME_SQL)
def streamed(spark, sf):
    model, rows = _trained(spark, sf)
    source, sink = new_path(spark, "stream-in"), new_path(spark, "stream-out")
    write_table(rows, source)
    stream = read_stream(spark, source, rows.schema, maxFilesPerTrigger=4)
    score_stream(model, stream, sink, new_path(spark, "stream-state")).awaitTermination()
    return _same(score(model, rows, probability=True), read_table(spark, sink))
