"""Per-subscriber features and the modelling dataset."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.columns import fill_zero
from tenura.operators.activity import with_keys
from tenura.operators.dataset import population_dataset, table_sources
from tenura.operators.feature_sets import (
    DURATION_SQL,
    FEATURE_SETS,
    FeatureSet,
    ranked_attributes_sql,
)
from tenura.operators.skew import (
    HOT_ROWS,
    HotGroups,
    Quantile,
    count_hot_groups,
    grouped_quantiles,
)
from tenura.schemas import AMOUNT_FEATURES, KEY, USAGE_FEATURES, USER_FEATURES

def with_duration(package: DataFrame) -> DataFrame:
    """Add the calendar days a package was active."""
    return package.withColumn("duration", F.expr(DURATION_SQL))


def aggregate_features(
    df: DataFrame,
    features: FeatureSet,
    keys: Sequence[str] = (KEY,),
    hot: HotGroups | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key with the features of a set. Counts include rows of null amounts."""
    rows = with_keys(df, keys).select(*keys, *features.columns())
    combined = {}
    if features.count:
        combined[features.count] = F.count(F.lit(1))
    combined.update({out: F.sum(column) for out, column in features.sums.items()})
    if not features.medians:
        return rows.groupBy(*keys).agg(*(agg.alias(out) for out, agg in combined.items()))
    medians = {out: Quantile(column) for out, column in features.medians.items()}
    found = grouped_quantiles(rows, keys, medians, combined, hot, hot_rows)
    return found.select(*keys, *features.names())


def user_attributes(
    user: DataFrame, as_of: datetime.date, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Age, registration year and account attributes, one row per key.

    Of several rows for one key one with the fewest nulls is kept, the smallest of these, so
    that reruns agree.
    """
    return (
        with_keys(user, keys)
        .groupBy(*keys)
        .agg(F.min(F.expr(ranked_attributes_sql(as_of))).alias("attributes"))
        .select(*keys, *(f"attributes.{c}" for c in USER_FEATURES))
    )


def subscriber_features(
    tables: Mapping[str, DataFrame],
    as_of: datetime.date,
    keys: Sequence[str] = (KEY,),
    hot_rows: int = HOT_ROWS,
) -> dict[str, DataFrame]:
    """The aggregates of all five activity tables and the user attributes, by table."""
    sources = {t: tables[t] for t in FEATURE_SETS}
    sources["package"] = with_duration(sources["package"])
    counted = {t: with_keys(df, keys) for t, df in sources.items() if FEATURE_SETS[t].medians}
    hot = count_hot_groups(counted, keys, hot_rows)
    found = {
        t: aggregate_features(df, FEATURE_SETS[t], keys, hot.get(t)) for t, df in sources.items()
    }
    found["user"] = user_attributes(tables["user"], as_of, keys)
    return found


def join_features(
    population: DataFrame, features: Mapping[str, DataFrame], keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Left joins onto the population; absent activity is 0, absent user attributes null.

    Every side has one row per key and is already hash-partitioned by the key, so the
    joins shuffle nothing more.
    """
    activity = [features[t] for t in FEATURE_SETS]
    joined = reduce(lambda left, right: left.join(right, list(keys), "left"), activity, population)
    filled = fill_zero(joined, AMOUNT_FEATURES + USAGE_FEATURES)
    return filled.join(features["user"], list(keys), "left")


def modelling_dataset(
    tables: Mapping[str, DataFrame],
    population: DataFrame,
    as_of: datetime.date,
    keys: Sequence[str] = (KEY,),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Labelled (or still unlabelled) population with all features of the six tables."""
    return population_dataset(table_sources(tables), population, as_of, keys, hot_rows)
