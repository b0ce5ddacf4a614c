"""Aggregates behind exploratory plots: counts, profiles, distributions, recovery ratios.

Every operator returns a small DataFrame that any plotting tool can draw. ``hue`` adds
a grouping column, as colour does in a plot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.skew import (
    HOT_ROWS,
    SKETCH_GROUPS,
    Quantile,
    grouped_quantiles,
    join_small,
    whole_table_quantiles,
)
from tenura.sources.shared import cut_lineage

PLOT_KINDS = ("count", "line", "box", "hist", "kde", "violin")
Hue = str | Sequence[str] | None
# Half-width of a 95 % band in standard errors.
BAND = 1.96


def _groups(hue: Hue) -> list[str]:
    return [hue] if isinstance(hue, str) else list(hue or [])


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per distinct combination of values, null included."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return value_counts(df, col).orderBy(F.desc("count"), F.asc_nulls_first(col)).limit(k)


def mode(df: DataFrame, col: str) -> DataFrame:
    """The most frequent non-null value, the smallest of several; no row if there is none."""
    return top_values(df.where(F.col(col).isNotNull()), col, 1).select(col)


def category_shares(df: DataFrame, col: str) -> DataFrame:
    """Count of each non-null value and its share of all of them."""
    counts = value_counts(df.where(F.col(col).isNotNull()), col)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def sum_by(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Sum of a column per key, such as loans per person."""
    return df.groupBy(key).agg(F.sum(col).alias(out))


def time_profile(df: DataFrame, ts: str, col: str) -> DataFrame:
    """Sums by hour, day of week (1 = Sunday) and day of month, ordered by time.

    The rows are first combined to at most one per (hour, weekday, day); the grouping
    sets expand only that.
    """
    parts = {
        "hour": F.hour(ts).alias("hour"),
        "day_of_week": F.dayofweek(ts).alias("day_of_week"),
        "day_of_month": F.dayofmonth(ts).alias("day_of_month"),
    }
    combined = df.groupBy(*parts.values()).agg(F.sum(col).alias("part_sum"))
    names = [F.col(p) for p in parts]
    sets = combined.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id().alias("absent"), F.sum("part_sum").alias("sum")
    )
    # grouping_id has one bit per column, set where the column is not part of the group.
    everything = 2 ** len(parts) - 1
    part = F
    for i, name in enumerate(parts):
        part = part.when(F.col("absent") == everything - 2 ** (len(parts) - 1 - i), F.lit(name))
    return sets.select(
        part.alias("time_part"), F.coalesce(*names).alias("value"), "sum"
    ).orderBy("time_part", "value")


def recovery_per_loan(assign: DataFrame, recovery: DataFrame) -> DataFrame:
    """Loan and recovered amounts per loan that is both assigned and recovered.

    Recoveries are summed per loan before the join, so a loan with many rows is one row.
    """
    sums = recovery.where(F.col("loan_id").isNotNull()).groupBy("loan_id").agg(
        F.sum("loan_amount").alias("sum_of_loan_amount"),
        F.sum("hsdp_recovery").alias("sum_of_recovery"),
    )
    return sums.join(assign.select("loan_id").distinct(), "loan_id", "left_semi")


def recovered_rows(assign: DataFrame, recovery: DataFrame) -> DataFrame:
    """Recovery rows of assigned loans. Adaptive execution splits the rows of a hot loan."""
    return recovery.join(assign.select("loan_id"), "loan_id", "left_semi")


def common_values(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Distinct values found in both tables; null counts as a value."""
    return left.select(col).intersect(right.select(col))


def recovery_ratio(
    assign: DataFrame, recovery: DataFrame, assigned_from: str = "recovery"
) -> DataFrame:
    """Recovered and assigned totals and the percentage recovered.

    The assigned total is summed from the recovery rows, where a loan recovered twice
    counts twice, or with ``assigned_from="assign"`` from the assigned loans themselves.
    """
    per_loan = recovery_per_loan(assign, recovery)
    if assigned_from == "assign":
        loans = assign.groupBy("loan_id").agg(F.sum("loan_amount").alias("assigned"))
        per_loan = per_loan.join(loans, "loan_id")
    elif assigned_from == "recovery":
        per_loan = per_loan.withColumnRenamed("sum_of_loan_amount", "assigned")
    else:
        raise ValueError(f"assigned_from must be recovery or assign, not {assigned_from!r}")
    totals = per_loan.agg(
        F.sum("sum_of_recovery").alias("recovered_sum"), F.sum("assigned").alias("assigned_sum")
    )
    ratio = F.try_divide(F.col("recovered_sum"), F.col("assigned_sum")) * 100
    return totals.withColumn("recovered_percent", ratio)


def recovery_bars(assign: DataFrame, recovery: DataFrame) -> DataFrame:
    """The two totals as one row per bar."""
    return recovery_ratio(assign, recovery).select(
        F.inline(
            F.array(
                F.struct(F.lit("RecoveredSum").alias("bar"), F.col("recovered_sum").alias("amount")),
                F.struct(F.lit("AssignedSum").alias("bar"), F.col("assigned_sum").alias("amount")),
            )
        )
    )


def approximate_medians(df: DataFrame, cols: Sequence[str], error: float = 0.01) -> DataFrame:
    """Medians of several columns to a relative rank error, in one pass; null if no values.

    Sketches are sized for half the error with 99 % confidence and merged in two levels.
    """
    size = min(max(math.ceil((2 * 2.296 / error) ** (1 / 0.9723)), 8), 65_535)
    values = df.select(*(F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols))
    parts = values.select("*", F.spark_partition_id().alias("_part")).groupBy(
        F.pmod("_part", F.lit(SKETCH_GROUPS))
    ).agg(*(F.kll_sketch_agg_double(c, size).alias(c) for c in cols))
    merged = parts.agg(*(F.kll_merge_agg_double(c, size).alias(c) for c in cols))
    found = [F.kll_sketch_get_quantile_double(c, F.lit(0.5)) for c in cols]
    return merged.select(
        *(F.when(F.kll_sketch_get_n_double(c) > 0, q).alias(c) for c, q in zip(cols, found))
    )


def exact_medians(df: DataFrame, cols: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Medians as values that occur in the columns; exact at any table size."""
    return grouped_quantiles(
        df, [], {c: Quantile(c, 0.5, interpolate=False) for c in cols}, hot_rows=hot_rows
    )


def line(df: DataFrame, x: str, y: str, hue: Hue = None) -> DataFrame:
    """Mean of y per x with a normal-theory 95 % band."""
    stats = df.where(F.col(x).isNotNull()).groupBy(x, *_groups(hue)).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd"), F.count(y).alias("n")
    )
    half = F.lit(BAND) * F.col("sd") / F.sqrt("n")
    return stats.withColumns({"low": F.col("mean") - half, "high": F.col("mean") + half})


def box(
    df: DataFrame, x: str, hue: Hue = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR of the box, and the number of points beyond."""
    groups = _groups(hue)
    value = F.nanvl(F.col(x).cast("double"), F.lit(None)).alias("v")
    rows = df.select(*groups, value).where(F.col("v").isNotNull())
    quartiles = {"q1": Quantile("v", 0.25), "median": Quantile("v"), "q3": Quantile("v", 0.75)}
    stats = grouped_quantiles(rows, groups, quartiles, hot_rows=hot_rows)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low_fence, high_fence = F.col("q1") - reach, F.col("q3") + reach
    fenced = join_small(rows, stats, groups)
    v = F.col("v")
    inside = (v >= low_fence) & (v <= high_fence)
    measures = ["q1", "median", "q3"]
    return fenced.groupBy(*groups, *measures).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def _auto_bins(n: int, low: float, high: float, iqr: float) -> int:
    """Number of equal bins: the finer of the Sturges and Freedman-Diaconis rules."""
    if not n or low == high:
        return 1
    widths = [(high - low) / (math.log2(n) + 1)]
    if iqr > 0:
        widths.append(2 * iqr / n ** (1 / 3))
    return math.ceil((high - low) / min(widths))


def histogram(
    df: DataFrame,
    x: str,
    bins: int | None = None,
    low: float | None = None,
    high: float | None = None,
    hue: Hue = None,
    hot_rows: int = HOT_ROWS,
    empty: bool = False,
) -> DataFrame:
    """Counts in equal bins over [low, high], the last one closed; bins from 0.

    Missing limits are the extremes of the data, a missing number of bins is chosen from
    it. Values below stated limits are counted in bin -1 (bin_low null), those above in bin
    ``bins`` (bin_high null), so the counts add up to the values; null and NaN are missing.
    Only bins with values are rows, unless ``empty`` ones of [low, high] are asked for.
    Groups of hue share the bins.
    """
    groups = _groups(hue)
    v = F.col("v")
    rows = df.select(*groups, F.nanvl(F.col(x).cast("double"), F.lit(None)).alias("v")).where(
        v.isNotNull()
    )
    found: dict = {}
    if bins is None:
        quartiles = {"q1": Quantile("v", 0.25), "q3": Quantile("v", 0.75)}
        summaries: dict = {}
        found = whole_table_quantiles(rows, quartiles, summaries)
        found |= {"low": summaries["v"].low, "high": summaries["v"].high, "n": summaries["v"].n}
    elif low is None or high is None:
        found = rows.agg(F.min("v").alias("low"), F.max("v").alias("high")).first().asDict()
    if low is None:
        low = found["low"]
    if high is None:
        high = found["high"]
    if low is None or high is None:
        low, high = 0.0, 1.0  # no rows
    if bins is None:
        bins = _auto_bins(found["n"], low, high, (found["q3"] or 0) - (found["q1"] or 0))
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.floor((v - F.lit(low)) / F.lit(high - low) * bins)
    place = F.least(place, F.lit(bins - 1))
    place = F.when(v < low, -1).when(v > high, bins).otherwise(place).cast("long")
    counts = rows.groupBy(*groups, place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if empty:
        counts = _with_empty_bins(counts, groups, bins)
    bin_ = F.col("bin")
    start = F.lit(low) + bin_ * F.lit(width)
    return counts.select(
        *groups,
        "bin",
        F.when(bin_ >= 0, start).alias("bin_low"),
        F.when(bin_ < bins, start + F.lit(width)).alias("bin_high"),
        "count",
    )


def _with_empty_bins(counts: DataFrame, groups: list[str], bins: int) -> DataFrame:
    """Rows for all bins from 0 to ``bins - 1`` of each group, with count 0 where none are."""
    numbers = counts.sparkSession.range(bins).select(F.col("id").alias("bin"))
    zero = numbers.withColumn("count", F.lit(0).cast("long"))
    if groups:
        # The groups are counted before they are broadcast.
        names = cut_lineage(counts.select(*groups).distinct()).withColumn("_one", F.lit(1))
        zero = join_small(zero.withColumn("_one", F.lit(1)), names, ["_one"]).drop("_one")
    both = counts.unionByName(zero.select(counts.columns))
    return both.groupBy(*groups, "bin").agg(F.sum("count").alias("count"))


def kde(
    df: DataFrame,
    x: str,
    hue: Hue = None,
    grid: int = 200,
    cut: float = 3.0,
    bins_per_bandwidth: int = 16,
) -> DataFrame:
    """Gaussian kernel density on an even grid per group, bandwidth by Scott's rule.

    Rows are first combined into bins much narrower than the bandwidth, each standing at
    the mean of its values; a bin reaches only the grid points within eight bandwidths.
    So the kernel work depends on the range and the grid, not on the number of rows.
    Densities of several groups add up to one, as shares of all rows. A group without
    spread has no density: one row, point 0 at its value (or null without values), whose
    density is null. Null and NaN are missing.
    """
    groups = _groups(hue)
    value = F.nanvl(F.col(x).cast("double"), F.lit(None)).alias("v")
    rows = df.select(*groups, value).where(F.col("v").isNotNull())
    bandwidth = F.stddev_samp("v") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))
    sizes = cut_lineage(
        rows.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            bandwidth.alias("bw"),
        )
    )
    total = sizes.agg(F.sum("n")).scalar()
    length = F.col("high") - F.col("low") + 2 * cut * F.col("bw")
    stats = sizes.where(F.col("bw") > 0).select(
        *groups,
        "low",
        "bw",
        (F.col("low") - cut * F.col("bw")).alias("start"),
        (length / (grid - 1)).alias("step"),
    )
    place = F.floor((F.col("v") - F.col("low")) / F.col("bw") * bins_per_bandwidth)
    binned = (
        join_small(rows, stats, groups, small_rows=stats.count())
        .groupBy(*groups, "bw", "start", "step", place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("weight"), F.avg("v").alias("at"))
    )
    reach = 8 * F.col("bw")
    first = F.ceil((F.col("at") - reach - F.col("start")) / F.col("step"))
    last = F.floor((F.col("at") + reach - F.col("start")) / F.col("step"))
    first = F.greatest(first, F.lit(0)).cast("int")
    last = F.least(last, F.lit(grid - 1)).cast("int")
    points = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    spread = binned.select("*", F.explode(points).alias("point"))
    z = (F.col("start") + F.col("point") * F.col("step") - F.col("at")) / F.col("bw")
    mass = spread.groupBy(*groups, "point").agg(
        F.sum(F.col("weight") * F.exp(-z * z / 2)).alias("mass")
    )
    frame = stats.select(
        *groups, "bw", "start", "step",
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"),
    )
    scale = F.lit(math.sqrt(2 * math.pi)) * F.col("bw") * total
    match = F.col("m.point") == F.col("f.point")
    for g in groups:
        match &= F.col(f"m.{g}").eqNullSafe(F.col(f"f.{g}"))
    spread_out = frame.alias("f").join(mass.alias("m"), match, "left").select(
        *(F.col(f"f.{g}") for g in groups),
        F.col("f.point").alias("point"),
        (F.col("start") + F.col("f.point") * F.col("step")).alias("x"),
        (F.coalesce(F.col("mass"), F.lit(0.0)) / scale).alias("density"),
    )
    single = sizes.where((F.col("n") > 0) & ~F.coalesce(F.col("bw") > 0, F.lit(False))).select(
        *groups, F.lit(0).alias("point"), F.col("low").alias("x"),
        F.lit(None).cast("double").alias("density"),
    )
    return spread_out.unionByName(single)


def violin(df: DataFrame, x: str, hue: Hue = None, grid: int = 200) -> DataFrame:
    """Density grid of each group together with its box measures."""
    return join_small(kde(df, x, hue, grid), box(df, x, hue), _groups(hue))


def distribution(
    df: DataFrame, kind: str, x: str, y: str | None = None, hue: Hue = None
) -> DataFrame:
    """The data of one plot kind. All but count and line show y, if given, for each x."""
    if kind not in PLOT_KINDS:
        raise ValueError(f"kind must be one of {PLOT_KINDS}, not {kind!r}")
    if kind == "count":
        if y is not None:
            raise ValueError("a count takes no y")
        return value_counts(df, x, *_groups(hue))
    if kind == "line":
        if y is None:
            raise ValueError("a line needs y")
        return line(df, x, y, hue)
    if kind in ("box", "violin"):
        make = box if kind == "box" else violin
        return make(df, y, [x, *_groups(hue)]) if y else make(df, x, hue)
    make = histogram if kind == "hist" else kde
    return make(df, y, hue=[x, *_groups(hue)]) if y else make(df, x, hue=hue)


def person_loan_histogram(assign: DataFrame, bins: int | None = None, **limits) -> DataFrame:
    """Histogram of the loan total per person."""
    totals = sum_by(assign, "nid_hash", "loan_amount", "total")
    return histogram(totals, "total", bins, **limits)
