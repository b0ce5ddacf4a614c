"""Column rules: parsing, filling, capping, log scaling and binning."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text formats of the landing files.
TIMESTAMP_FORMAT = "yyyyMMdd HH:mm:ss"
DATE_FORMAT = "yyyyMMdd"

# Bin edges and names used in the exploratory reports.
DURATION_EDGES = [-math.inf, 0, 1, 7, 15, 30, 60, 120, 180, 365, math.inf]
DURATION_NAMES = [
    "Same Day", "Daily", "Weekly", "Half-Monthly", "Monthly",
    "2 Months", "4 Months", "6 Months", "1 Year", "More than 1 Year",
]
LOAN_EDGES = [-math.inf, 5000, 10000, 20000, 50000, 100000, math.inf]
LOAN_NAMES = ["VeryLow", "5T-10T", "10T-20T", "20T-50T", "50T-100T", "Extreme"]
RECHARGE_EDGES = [-math.inf, 10000, 20000, 50000, 100000, 200000, 500000, math.inf]
RECHARGE_NAMES = ["1T", "2T", "5T", "10T", "20T", "50T", "More"]


def date_parsers(timestamps: Sequence[str] = (), dates: Sequence[str] = ()) -> dict[str, Column]:
    """Timestamps and dates of text columns, by column; unreadable text is null."""
    parsed = {c: F.try_to_timestamp(F.col(c), F.lit(TIMESTAMP_FORMAT)) for c in timestamps}
    return parsed | {c: F.try_to_date(F.col(c), DATE_FORMAT) for c in dates}


def parse_dates(
    df: DataFrame, timestamps: Sequence[str] = (), dates: Sequence[str] = ()
) -> DataFrame:
    """Turn text columns into timestamps and dates; unreadable text becomes null."""
    parsed = date_parsers(timestamps, dates)
    missing = [c for c in parsed if c not in df.columns]
    if missing:
        warnings.warn(f"columns not found, not parsed: {missing}", stacklevel=2)
    return df.withColumns({c: e for c, e in parsed.items() if c not in missing})


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column, all in one projection."""
    return df.na.fill(dict(values))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls and NaNs by 0 in the named numeric columns only."""
    return df.na.fill(0, subset=list(cols))


def cap(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; null stays null."""
    if high is not None:
        value = F.when(value > high, F.lit(high)).otherwise(value)
    if low is not None:
        value = F.when(value < low, F.lit(low)).otherwise(value)
    return value


def log_sql(value: str, on_invalid: str = "null") -> str:
    """SQL for ln(1 + x). Below its domain: null, mirrored sign ("signed"), or an error."""
    if on_invalid == "null":
        return f"log1p({value})"
    if on_invalid == "signed":
        return f"signum({value}) * log1p(abs({value}))"
    if on_invalid == "error":
        fail = "CAST(raise_error('log scale needs values above -1') AS DOUBLE)"
        return f"CASE WHEN {value} <= -1 THEN {fail} ELSE log1p({value}) END"
    raise ValueError(f"on_invalid must be null, signed or error, not {on_invalid!r}")


def log_scale(df: DataFrame, cols: Sequence[str], on_invalid: str = "null") -> DataFrame:
    """Replace columns by ln(1 + x), all in one projection."""
    return df.withColumns({c: F.expr(log_sql(f"`{c}`", on_invalid)) for c in cols})


def range_label(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the half-open range (edge, next edge] a value falls in.

    A value in no range keeps its own text; null stays null.
    """
    if not edges or not names:
        raise ValueError("edges and names must not be empty")
    if len(edges) != len(names) + 1:
        raise ValueError(f"{len(names)} names need {len(names) + 1} edges, got {len(edges)}")
    label = F
    for low, high, name in zip(edges, edges[1:], names):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        label = label.when(inside, F.lit(name))
    return label.otherwise(value.cast("string"))


def categorize(
    df: DataFrame, col: str, edges: Sequence[float], names: Sequence[str], out: str = "category"
) -> DataFrame:
    """Add the range name of a numeric column."""
    return df.withColumn(out, range_label(F.col(col), edges, names))


def categorize_loans(df: DataFrame, col: str = "loan_amount") -> DataFrame:
    return categorize(df, col, LOAN_EDGES, LOAN_NAMES, "loan_category")


def categorize_recharges(df: DataFrame, col: str = "recharge_value_amt") -> DataFrame:
    return categorize(df, col, RECHARGE_EDGES, RECHARGE_NAMES, "recharge_category")


def categorize_durations(
    df: DataFrame,
    start: str = "activation_date",
    end: str = "deactivation_date",
    days_out: str = "time_difference_days",
) -> DataFrame:
    """Add the calendar days between two columns and the name of their range."""
    days = F.datediff(F.col(end), F.col(start))
    return df.withColumns(
        {days_out: days, "duration_category": range_label(days, DURATION_EDGES, DURATION_NAMES)}
    )
