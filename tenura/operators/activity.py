"""Subscriber activity, churn labels and populations.

Activity is a table of (key, ts) rows taken from any number of sources. Everything here
is one grouped max/min over such rows, so each label costs a single shuffle of partly
combined rows, whatever the number of sources or periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.schemas import KEY

GAP_DAYS = 30


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def with_keys(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Rows whose keys are all set."""
    return df.where(~_null_key(keys))


def null_key_count(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """How many rows ``with_keys`` leaves out; reads only the key columns."""
    return df.agg(F.count_if(_null_key(keys)).alias("null_keys"))


def null_key_counts(
    tables: Mapping[str, DataFrame], keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Rows of each table that ``with_keys`` leaves out: table, null_keys."""
    counts = [
        null_key_count(df, keys).select(F.lit(name).alias("table"), "null_keys")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def activity_rows(
    sources: Sequence[tuple[DataFrame, str]], keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """(key, ts) rows of several tables, each given with its timestamp column."""
    parts = [df.select(*keys, F.col(column).alias("ts")) for df, column in sources]
    return with_keys(reduce(DataFrame.unionByName, parts), keys)


def package_recharge_activity(
    package: DataFrame, recharge: DataFrame, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """The activity that labels are made from: package activations and recharges."""
    return activity_rows([(package, "activation_date"), (recharge, "recharge_dt")], keys)


def activity_bound(activity: DataFrame, which: str, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Last ("max") or first ("min") activity per key."""
    if which not in ("max", "min"):
        raise ValueError(f"which must be max or min, not {which!r}")
    bound = F.max if which == "max" else F.min
    return activity.groupBy(*keys).agg(bound("ts").alias(f"{which}_date"))


def churned(last: Column, first_next: Column, gap_days: int = GAP_DAYS) -> Column:
    """1 if a subscriber seen before is absent afterwards or returns after the gap, else 0."""
    absent = last.isNotNull() & first_next.isNull()
    late = F.datediff(first_next, last) > gap_days
    return F.when(absent | late, 1).otherwise(0)


def _label(tagged: DataFrame, keys: Sequence[str], gap_days: int) -> DataFrame:
    current = F.col("is_current")
    bounds = tagged.groupBy(*keys).agg(
        F.max(current).alias("in_population"),
        F.max(F.when(current, F.col("ts"))).alias("last"),
        F.min(F.when(~current, F.col("ts"))).alias("first_next"),
    )
    label = churned(F.col("last"), F.col("first_next"), gap_days)
    return bounds.where("in_population").select(*keys, label.alias("label"))


def churn_label(
    current: DataFrame,
    following: DataFrame,
    gap_days: int = GAP_DAYS,
    keys: Sequence[str] = (KEY,),
) -> DataFrame:
    """Label every key with a row in the current period, even one whose dates are all null."""
    tagged = current.withColumn("is_current", F.lit(True)).unionByName(
        following.withColumn("is_current", F.lit(False))
    )
    return _label(tagged, keys, gap_days)


def churn_label_between(
    activity: DataFrame,
    start: Column,
    middle: Column,
    end: Column,
    gap_days: int = GAP_DAYS,
    keys: Sequence[str] = (KEY,),
) -> DataFrame:
    """Label from one table by time range: current [start, middle), next [middle, end).

    Rows without a date are in neither range, so unlike ``churn_label`` they do not put
    their key into the population.
    """
    ts = F.col("ts")
    inside = activity.where((ts >= start) & (ts < end))
    return _label(inside.withColumn("is_current", ts < middle), keys, gap_days)


def churn_labels(
    activity: DataFrame,
    months: Sequence[str],
    gap_days: int = GAP_DAYS,
    keys: Sequence[str] = (KEY,),
    month_col: str = "month",
) -> DataFrame:
    """Labels of every month that has a next one in the ordered list, in one pass.

    A row counts as current for its own month and as following for the month before. Rows
    of months that aren't in the list take no part.
    """
    if len(months) < 2:
        raise ValueError("labels need at least two consecutive months")
    names = F.array(*(F.lit(m) for m in months))
    # Positions count from 1; a month not in the list is at 0, the last one has no label.
    placed = activity.select(
        *keys, "ts", F.array_position(names, F.col(month_col)).cast("int").alias("at")
    )
    tagged = placed.select(
        *keys,
        "ts",
        F.explode(F.array(F.lit(True), F.lit(False))).alias("is_current"),
        "at",
    ).withColumn("period", F.when(F.col("is_current"), F.col("at")).otherwise(F.col("at") - 1))
    labelled = tagged.where(F.col("period").between(1, len(months) - 1)).drop("at")
    month = F.element_at(names, F.col("period"))
    labels = _label(labelled, ["period", *keys], gap_days)
    return labels.select(month.alias(month_col), *keys, "label")


def churn_labels_of_summaries(
    summaries: DataFrame,
    months: Sequence[str],
    gap_days: int = GAP_DAYS,
    keys: Sequence[str] = (KEY,),
    month_col: str = "month",
) -> DataFrame:
    """``churn_labels`` from one row (first, last) per key and month.

    A key's months are looked at in order, so a table bucketed by key needs no exchange.
    """
    if len(months) < 2:
        raise ValueError("labels need at least two consecutive months")
    names = F.array(*(F.lit(m) for m in months))
    at = F.array_position(names, F.col(month_col)).cast("int")
    placed = summaries.withColumn("at", at).where(F.col("at") > 0)
    in_order = Window.partitionBy(*keys).orderBy("at")
    follows = F.lead("at").over(in_order) == F.col("at") + 1
    label = churned(F.col("last"), F.when(follows, F.lead("first").over(in_order)), gap_days)
    # As with rows, a key without any date is in the population and counts as not churned.
    return placed.select(month_col, *keys, label.alias("label"), "at").where(F.col("at") < len(months)).drop("at")


def activity_bounds_of_summaries(summaries: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """First and last activity and number of rows per key, from one row per key and month."""
    return summaries.groupBy(*keys).agg(
        F.min("first").alias("min_date"), F.max("last").alias("max_date"), F.sum("n").alias("n_rows")
    )


def scoring_population(tables: Sequence[DataFrame], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Distinct keys found in any of the tables, with an unknown (null) label."""
    found = reduce(DataFrame.union, [df.select(*keys) for df in tables])
    return with_keys(found, keys).distinct().withColumn("label", F.lit(None).cast("int"))


def combine_outer(parts: Mapping[str, DataFrame], keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Full outer join of (key, ts) tables with one row per key, as one grouped union.

    Each part becomes the column it is named after.
    """
    tagged = [
        df.select(*keys, F.lit(name).alias("part"), "ts") for name, df in parts.items()
    ]
    columns = [F.max(F.when(F.col("part") == name, F.col("ts"))).alias(name) for name in parts]
    return reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(*columns)
