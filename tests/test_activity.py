import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenura.operators.activity import (
    activity_bound,
    activity_rows,
    churn_label,
    churn_label_between,
    churn_labels,
    combine_outer,
    null_key_count,
    package_recharge_activity,
    scoring_population,
    with_keys,
)
from tests.plans import exchanges

PACKAGE = "bib_id string, activation_date timestamp"
RECHARGE = "bib_id string, recharge_dt timestamp"
ACTIVITY = "bib_id string, ts timestamp"


def at(month, day, hour=0, minute=0, second=0):
    return dt.datetime(2024, month, day, hour, minute, second)


@pytest.fixture()
def periods(rows):
    current_package = rows(PACKAGE, [
        ("u1", at(1, 10)), ("u2", at(1, 10)), ("u4", at(1, 31, 23, 59, 59)),
        ("u5", None), ("u6", None), ("u8", at(1, 31)), (None, at(1, 10)),
    ])
    current_recharge = rows(RECHARGE, [("u2", at(1, 20)), ("u3", at(1, 20))])
    next_package = rows(PACKAGE, [
        ("u2", at(2, 19)), ("u4", at(2, 1, 0, 0, 1)), ("u5", at(2, 5)), ("u7", at(2, 5)),
        ("u8", at(1, 30)), (None, at(2, 5)),
    ])
    next_recharge = rows(RECHARGE, [("u3", at(2, 20))])
    return (
        package_recharge_activity(current_package, current_recharge),
        package_recharge_activity(next_package, next_recharge),
    )


def test_label_truth_table(periods):
    labels = {r["bib_id"]: r["label"] for r in churn_label(*periods).collect()}
    assert labels == {"u1": 1, "u2": 0, "u3": 1, "u4": 0, "u5": 0, "u6": 0, "u8": 0}


def test_label_type_and_single_row_per_key(periods):
    labels = churn_label(*periods)
    assert labels.dtypes == [("bib_id", "string"), ("label", "int")]
    assert labels.count() == labels.select("bib_id").distinct().count()


def test_label_by_time_range_leaves_out_undated_rows(periods):
    both = periods[0].unionByName(periods[1])
    limits = [F.lit(at(1, 1)), F.lit(at(2, 1)), F.lit(at(3, 1))]
    labels = {r["bib_id"]: r["label"] for r in churn_label_between(both, *limits).collect()}
    # u5 and u6 have no dated row in the current period; u8's second row is in January.
    assert labels == {"u1": 1, "u2": 0, "u3": 1, "u4": 0, "u8": 1}


def test_label_ignores_row_order_and_partitioning(periods):
    expected = sorted(churn_label(*periods).collect())
    shuffled = [p.orderBy(F.rand(3)).repartition(3) for p in periods]
    assert sorted(churn_label(*shuffled).collect()) == expected


def test_label_gap_is_a_parameter(periods):
    labels = {r["bib_id"]: r["label"] for r in churn_label(*periods, gap_days=31).collect()}
    assert labels["u3"] == 0


def test_label_of_empty_input_is_empty(rows):
    empty = rows(ACTIVITY, [])
    labels = churn_label(empty, empty)
    assert labels.columns == ["bib_id", "label"] and labels.count() == 0


def test_label_is_one_shuffle(rows):
    current, following = rows(ACTIVITY, [("a", at(1, 1))]), rows(ACTIVITY, [("a", at(2, 1))])
    assert exchanges(churn_label(current, following)) == 1


def test_labels_of_all_months_match_pairwise_labels(rows):
    data = [(f"u{i % 7}", at(1 + i % 5, 1 + (i * 11) % 28), str(1 + i % 5)) for i in range(60)]
    data += [("u0", None, "2"), ("only-null", None, "1")]
    activity = rows("bib_id string, ts timestamp, month string", data)
    months = ["1", "2", "3", "4", "5"]
    found = set(map(tuple, churn_labels(activity, months).collect()))
    expected = set()
    for month, following in zip(months, months[1:]):
        pair = [activity.where(F.col("month") == m).drop("month") for m in (month, following)]
        expected |= {(month, *r) for r in churn_label(*pair).collect()}
    assert found == expected
    with pytest.raises(ValueError):
        churn_labels(activity, ["1"])


def test_null_keys_are_dropped_and_counted(rows):
    df = rows(ACTIVITY, [("a", None), (None, at(1, 1)), (None, None)])
    assert with_keys(df).count() == 1
    assert null_key_count(df).first()["null_keys"] == 2
    assert null_key_count(df, ["bib_id", "ts"]).first()["null_keys"] == 3


def test_bounds_and_unknown_bound(rows):
    activity = rows(ACTIVITY, [("a", at(1, 5)), ("a", at(1, 2)), ("b", None)])
    assert dict(activity_bound(activity, "max").collect()) == {"a": at(1, 5), "b": None}
    assert dict(activity_bound(activity, "min").collect()) == {"a": at(1, 2), "b": None}
    with pytest.raises(ValueError):
        activity_bound(activity, "avg")


def test_union_form_equals_full_outer_join(rows):
    package = rows(PACKAGE, [("a", at(1, 5)), ("a", at(1, 9)), ("b", at(1, 1))])
    recharge = rows(RECHARGE, [("a", at(1, 7)), ("c", at(1, 3)), ("c", None)])
    joined = (
        package.groupBy("bib_id").agg(F.max("activation_date").alias("p"))
        .join(recharge.groupBy("bib_id").agg(F.max("recharge_dt").alias("r")), "bib_id", "full")
    )
    expected = joined.select("bib_id", F.greatest("p", "r").alias("max_date"))
    found = activity_bound(package_recharge_activity(package, recharge), "max")
    assert sorted(found.collect()) == sorted(expected.collect())
    sides = combine_outer({
        "p": activity_rows([(package, "activation_date")]),
        "r": activity_rows([(recharge, "recharge_dt")]),
    })
    assert sorted(sides.collect(), key=str) == sorted(joined.collect(), key=str)


def test_population_is_distinct(rows):
    package = rows(PACKAGE, [("a", at(1, 1)), ("a", at(1, 2)), (None, at(1, 3))])
    recharge = rows(RECHARGE, [("a", at(1, 1))] * 3 + [("b", None)])
    found = scoring_population([package, recharge])
    assert sorted(map(tuple, found.collect())) == [("a", None), ("b", None)]
    assert found.dtypes == [("bib_id", "string"), ("label", "int")]
