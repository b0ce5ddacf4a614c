import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tenura.functions.columns import (
    cap,
    categorize,
    categorize_durations,
    categorize_loans,
    categorize_recharges,
    fill_nulls,
    fill_zero,
    log_scale,
    parse_dates,
    range_label,
)
from tests.conftest import by_key


def test_parse_dates(rows):
    text = rows("k int, d string, t string", [
        (1, "20240131", "20240131 23:59:59"), (2, "2024x", "20240131"), (3, "", ""), (4, None, None),
    ])
    with pytest.warns(UserWarning, match="absent"):
        parsed = parse_dates(text, ["t", "absent"], ["d"])
    assert parsed.dtypes == [("k", "int"), ("d", "date"), ("t", "timestamp")]
    assert by_key(parsed) == {
        1: (1, dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 23, 59, 59)),
        2: (2, None, None), 3: (3, None, None), 4: (4, None, None),
    }


def test_fill_zero_touches_only_named_numbers(rows):
    df = rows("a double, b int, s string", [(None, None, None), (math.nan, 1, "x")])
    assert sorted(fill_zero(df, ["a", "b"]).collect(), key=str) == sorted(
        [(0.0, 0, None), (0.0, 1, "x")], key=str)
    assert fill_nulls(df, {"s": "?"}).where("s = '?'").count() == 1


def test_cap_keeps_null(rows):
    df = rows("k int, age double", [(1, 99.9), (2, 100.0), (3, 100.1), (4, None)])
    capped = by_key(df.select("k", cap(F.col("age"), high=100.0)))
    assert [capped[k][1] for k in range(1, 5)] == [99.9, 100.0, 100.0, None]
    both = by_key(df.select("k", cap(F.col("age"), 99.95, 100.0)))
    assert both[1][1] == 99.95 and both[4][1] is None


def test_log_scale_policies(rows):
    df = rows("k int, x double", [(1, -2.0), (2, -1.0), (3, -0.5), (4, 0.0), (5, 10.0)])
    nulls = [by_key(log_scale(df, ["x"]))[k][1] for k in range(1, 6)]
    assert nulls[:2] == [None, None]
    assert nulls[2:] == pytest.approx([math.log(0.5), 0.0, math.log(11)])
    signed = by_key(log_scale(df, ["x"], "signed"))
    assert signed[1][1] == pytest.approx(-math.log(3))
    with pytest.raises(Exception, match="above -1"):
        log_scale(df, ["x"], "error").collect()
    assert log_scale(df.where("x > -1"), ["x"], "error").count() == 3
    with pytest.raises(ValueError):
        log_scale(df, ["x"], "other")


def test_range_label_edges(rows):
    df = rows("k int, x double", [
        (1, -math.inf), (2, -5.0), (3, 0.0), (4, 0.1), (5, 10.0), (6, 10.5), (7, math.inf),
        (8, math.nan), (9, None),
    ])
    labels = by_key(categorize(df, "x", [-math.inf, 0, 10, math.inf], ["low", "mid", "high"]))
    assert [labels[k][2] for k in range(1, 10)] == [
        "-Infinity", "low", "low", "mid", "mid", "high", "high", "NaN", None,
    ]
    open_ended = by_key(categorize(df, "x", [0, 10], ["in"], "c"))
    assert [open_ended[k][2] for k in (2, 4, 6)] == ["-5.0", "in", "10.5"]


@pytest.mark.parametrize("edges, names", [([0, 1], []), ([], []), ([0, 1, 2], ["a"])])
def test_range_label_rejects_bad_edges(edges, names):
    with pytest.raises(ValueError):
        range_label(F, edges, names)


def test_duration_categories(rows):
    days = [-3, 0, 1, 2, 7, 8, 15, 16, 30, 31, 60, 61, 120, 121, 180, 181, 365, 366]
    names = ["Same Day", "Same Day", "Daily", "Weekly", "Weekly", "Half-Monthly", "Half-Monthly",
             "Monthly", "Monthly", "2 Months", "2 Months", "4 Months", "4 Months", "6 Months",
             "6 Months", "1 Year", "1 Year", "More than 1 Year"]
    start = dt.datetime(2024, 1, 1, 18)
    df = rows("activation_date timestamp, deactivation_date timestamp",
              [(start, start + dt.timedelta(days=d)) for d in days] + [(start, None)])
    found = by_key(categorize_durations(df).select("time_difference_days", "duration_category"))
    assert [found[d][1] for d in days] == names
    assert found[None] == (None, None)


def test_preset_amount_categories(rows):
    loans = by_key(categorize_loans(rows("loan_amount double", [(5000.0,), (5000.1,), (1e6,)])))
    assert [loans[v][1] for v in (5000.0, 5000.1, 1e6)] == ["VeryLow", "5T-10T", "Extreme"]
    found = by_key(categorize_recharges(
        rows("recharge_value_amt double", [(10000.0,), (20001.0,), (500001.0,)])))
    assert [v[1] for v in found.values()] == ["1T", "5T", "More"]
