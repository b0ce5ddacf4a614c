import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import explore
from tests.conftest import by_key

LOANS = "loan_id string, loan_amount double"
RECOVERIES = "loan_id string, loan_amount double, hsdp_recovery double"


@pytest.fixture()
def values(spark):
    return spark.range(900).select(
        (F.randn(4) * 10 + F.col("id") % 3 * 15).alias("v"),
        F.when(F.col("id") % 3 < 2, (F.col("id") % 3).cast("string")).alias("g"),
    ).repartition(3).cache()


def pulled(df, col="v"):
    return np.array([r[0] for r in df.select(col).collect()])


def test_top_values_break_ties_by_value(rows):
    df = rows("x string", [("b",), ("a",), ("b",), ("a",), ("c",), (None,)])
    assert [tuple(r) for r in explore.top_values(df, "x", 3).collect()] == [
        ("a", 2), ("b", 2), (None, 1)]


def test_mode_ignores_null_and_takes_the_smallest(rows):
    df = rows("x int", [(None,)] * 5 + [(3,), (2,), (3,), (2,), (9,)])
    assert explore.mode(df, "x").collect() == [(2,)]
    assert explore.mode(df.where("x IS NULL"), "x").collect() == []


def test_category_shares_leave_out_null(rows):
    df = rows("x string", [("F",), ("F",), ("M",), (None,)])
    found = by_key(explore.category_shares(df, "x"))
    assert found == {"F": ("F", 2, pytest.approx(2 / 3)), "M": ("M", 1, pytest.approx(1 / 3))}


def test_time_profile_is_ordered_by_time(rows):
    sunday, monday = dt.datetime(2024, 1, 7, 10), dt.datetime(2024, 1, 8, 9)
    df = rows("t timestamp, x double", [(sunday, 1.0), (monday, 2.0), (monday, 4.0)])
    assert [tuple(r) for r in explore.time_profile(df, "t", "x").collect()] == [
        ("day_of_month", 7, 1.0), ("day_of_month", 8, 6.0), ("day_of_week", 1, 1.0),
        ("day_of_week", 2, 6.0), ("hour", 9, 6.0), ("hour", 10, 1.0)]


def test_time_profile_keeps_rows_without_a_time(rows):
    df = rows("t timestamp, x double", [(None, 1.0), (dt.datetime(2024, 1, 1), 2.0)])
    found = {tuple(r) for r in explore.time_profile(df, "t", "x").collect()}
    assert ("hour", None, 1.0) in found and ("hour", 0, 2.0) in found and len(found) == 6


def test_recovery(rows):
    assign = rows(LOANS, [("1", 100.0), ("2", 50.0), ("3", 10.0), (None, 5.0)])
    recovery = rows(RECOVERIES, [
        ("1", 100.0, 30.0), ("1", 100.0, 20.0), ("2", 50.0, 50.0), ("9", 1.0, 1.0),
        (None, 5.0, 5.0)])
    assert by_key(explore.recovery_per_loan(assign, recovery)) == {
        "1": ("1", 200.0, 50.0), "2": ("2", 50.0, 50.0)}
    assert explore.recovered_rows(assign, recovery).count() == 3
    assert sorted(explore.common_values(assign, recovery, "loan_id").collect(), key=str) == [
        ("1",), ("2",), (None,)]
    assert explore.recovery_ratio(assign, recovery).first() == (100.0, 250.0, 40.0)
    from_assign = explore.recovery_ratio(assign, recovery, "assign").first()
    assert from_assign == (100.0, 150.0, pytest.approx(200 / 3))
    assert sorted(map(tuple, explore.recovery_bars(assign, recovery).collect())) == [
        ("AssignedSum", 250.0), ("RecoveredSum", 100.0)]
    with pytest.raises(ValueError):
        explore.recovery_ratio(assign, recovery, "other")


@pytest.mark.parametrize("amount", [0.0, None])
def test_recovery_ratio_without_assigned_amount_is_null(rows, amount):
    assign = rows(LOANS, [("1", amount)])
    recovery = rows(RECOVERIES, [("1", amount, 5.0)])
    assert explore.recovery_ratio(assign, recovery).first()["recovered_percent"] is None
    nothing = explore.recovery_ratio(assign.where("false"), recovery)
    assert nothing.first() == (None, None, None)


def test_medians(values, rows):
    exact = explore.exact_medians(values, ["v"]).first()["v"]
    assert exact == np.quantile(pulled(values), 0.5, method="inverted_cdf")
    assert explore.exact_medians(values, ["v"], hot_rows=10).first()["v"] == exact
    near = explore.approximate_medians(values, ["v"]).first()["v"]
    assert abs((pulled(values) <= near).mean() - 0.5) <= 0.01
    odd = rows("x double", [(None,), (math.nan,), (2.0,)])
    assert explore.approximate_medians(odd, ["x"]).first()["x"] == 2.0
    assert explore.approximate_medians(odd.where("x < 0"), ["x"]).first()["x"] is None


def test_line_band(rows):
    df = rows("x int, y double", [(1, 1.0), (1, 3.0), (1, None), (2, 5.0), (None, 1.0)])
    found = by_key(explore.distribution(df, "line", "x", "y").select("x", "mean", "n", "low", "high"))
    half = 1.96 * math.sqrt(2) / math.sqrt(2)
    assert found == {1: (1, 2.0, 2, pytest.approx(2 - half), pytest.approx(2 + half)),
                     2: (2, 5.0, 1, None, None)}
    with pytest.raises(ValueError):
        explore.distribution(df, "line", "x")


def test_box_measures(rows):
    df = rows("v double", [(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]] + [(None,)])
    row = explore.distribution(df, "box", "v").first().asDict()
    assert row == {"q1": 3.25, "median": 5.5, "q3": 7.75, "n": 10, "whisker_low": 1.0,
                   "whisker_high": 9.0, "outliers": 1}


def test_box_by_group_with_hot_groups(values):
    plain = sorted(explore.box(values, "v", "g").collect(), key=str)
    assert sorted(explore.box(values, "v", "g", hot_rows=50).collect(), key=str) == plain
    assert {r["g"] for r in plain} == {"0", "1", None}
    two = explore.distribution(values.withColumn("h", F.lit("x")), "box", "g", "v", "h")
    assert two.columns[:2] == ["g", "h"] and two.count() == 3


def test_histogram_counts_every_value_once(values):
    data = pulled(values)
    for bins in (7, None):
        found = explore.histogram(values, "v", bins, empty=True).orderBy("bin").collect()
        edges = np.histogram_bin_edges(data, bins or "auto")
        assert len(found) == len(edges) - 1
        assert [r["count"] for r in found] == list(np.histogram(data, edges)[0])
        assert [r["bin_low"] for r in found] == pytest.approx(list(edges[:-1]))
    grouped = explore.histogram(values, "v", 5, hue="g", empty=True)
    assert grouped.agg(F.sum("count")).first()[0] == 900 and grouped.count() == 15


def test_histogram_edge_cases(rows):
    same = rows("v double", [(2.0,), (2.0,), (None,), (math.nan,)])
    assert [r["count"] for r in explore.histogram(same, "v").collect()] == [2]
    empty = explore.histogram(same.where("v < 0"), "v")
    assert empty.collect() == []
    assert [r["count"] for r in explore.histogram(same.where("v < 0"), "v", 2, empty=True).collect()] == [0, 0]
    limited = explore.histogram(rows("v double", [(0.0,), (5.0,), (10.0,), (11.0,)]), "v", 2, 0, 10)
    assert [tuple(r) for r in limited.orderBy("bin").collect()] == [
        (0, 0.0, 5.0, 1), (1, 5.0, 10.0, 2), (2, 10.0, None, 1)]
    below = explore.histogram(rows("v double", [(-1.0,), (5.0,)]), "v", 2, 0, 10)
    assert [tuple(r) for r in below.orderBy("bin").collect()] == [(-1, None, 0.0, 1), (1, 5.0, 10.0, 1)]


def test_default_histogram_with_an_outlier(rows):
    """Bins by the spread of the middle half: thousands of millions, of which few are rows."""
    df = rows("v double", [(float(i % 97),) for i in range(1000)] + [(1e12,)])
    found = explore.histogram(df, "v").collect()
    assert sum(r["count"] for r in found) == 1001 and len(found) <= 98


def test_nan_is_missing(rows):
    df = rows("g string, v double", [("a", v) for v in (1.0, 2.0, 3.0, 4.0, math.nan, None)])
    whole = df.where("v is not null and not isnan(v)")
    for make in (explore.box, explore.kde, explore.violin, explore.histogram):
        assert sorted(make(df, "v").collect(), key=str) == sorted(make(whole, "v").collect(), key=str)
        grouped = make(df, "v", hue="g")
        assert sorted(grouped.collect(), key=str) == sorted(make(whole, "v", hue="g").collect(), key=str)
    assert explore.exact_medians(df, ["v"]).first()["v"] == 2.0


def test_groups_without_spread_stay(rows):
    df = rows("g string, v double", [("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 3.0), ("c", 3.0)])
    found = explore.violin(df, "v", "g")
    assert {r["g"] for r in found.collect()} == {r["g"] for r in explore.box(df, "v", "g").collect()}
    assert [(r["x"], r["density"]) for r in found.where("g = 'b'").collect()] == [(5.0, None)]


def test_distribution_of_y_for_each_x(values):
    for kind in ("hist", "kde"):
        found = explore.distribution(values, kind, "g", "v")
        assert {r["g"] for r in found.collect()} == {"0", "1", None}
    with pytest.raises(ValueError):
        explore.distribution(values, "count", "g", "v")


def kernel_density(data, grid):
    width = data.std(ddof=1) * len(data) ** -0.2
    z = (grid[:, None] - data[None, :]) / width
    return np.exp(-z * z / 2).sum(axis=1) / (len(data) * width * math.sqrt(2 * math.pi))


def test_density_is_close_to_the_full_kernel_sum(values):
    found = explore.kde(values, "v").orderBy("point").collect()
    grid = np.array([r["x"] for r in found])
    expected = kernel_density(pulled(values), grid)
    assert len(found) == 200
    assert np.array([r["density"] for r in found]) == pytest.approx(expected, abs=expected.max() * 1e-3)
    width = grid[1] - grid[0]
    assert sum(r["density"] for r in found) * width == pytest.approx(1, abs=2e-3)


def test_density_by_group_adds_up_to_one(values):
    found = explore.kde(values, "v", "g", grid=100).collect()
    total = 0
    for group in ("0", "1", None):
        points = sorted((r["x"], r["density"]) for r in found if r["g"] == group)
        total += sum(d for _, d in points) * (points[1][0] - points[0][0])
    assert total == pytest.approx(1, abs=5e-3)


def test_violin_has_density_and_box(values):
    found = explore.distribution(values, "violin", "v", hue="g")
    assert {"point", "density", "median", "outliers"} <= set(found.columns)
    assert found.count() == 600
    assert explore.violin(values, "v", grid=10).count() == 10


def test_unknown_kind_and_counts(rows):
    df = rows("x string, h string", [("a", "p"), ("a", "q"), ("a", "p")])
    found = {tuple(r) for r in explore.distribution(df, "count", "x", hue="h").collect()}
    assert found == {("a", "p", 2), ("a", "q", 1)}
    with pytest.raises(ValueError, match="kind"):
        explore.distribution(df, "pie", "x")


def test_person_loan_histogram(rows):
    df = rows("nid_hash string, loan_amount double", [("p", 1.0), ("p", 2.0), ("q", 9.0)])
    found = explore.person_loan_histogram(df, 2, low=0.0, high=10.0).orderBy("bin")
    assert [r["count"] for r in found.collect()] == [1, 1]
    assert explore.preview(df, 1, ["loan_amount"]).collect() == [("p", 1.0)]
