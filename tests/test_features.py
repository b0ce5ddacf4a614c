import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenura.operators.features import (
    FEATURE_SETS,
    FeatureSet,
    aggregate_features,
    join_features,
    modelling_dataset,
    subscriber_features,
    user_attributes,
    with_duration,
)
from tenura.schemas import (
    AMOUNT_FEATURES,
    TABLES,
    USAGE_FEATURES,
    USER_FEATURES,
    conform,
    loaded_schema,
)
from tests.conftest import by_key
from tests.plans import exchanges

AS_OF = dt.date(2024, 1, 1)
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture()
def tables(rows):
    data = {
        "loan_assign": rows("bib_id string, loan_amount double",
                            [("a", 1.0), ("a", 2.0), ("a", None), ("b", None), (None, 9.0)]),
        "loan_recovery": rows("bib_id string, loan_amount double, hsdp_recovery double",
                              [("a", 4.0, 100.0)]),
        "package": rows("bib_id string, offer_amount double, activation_date timestamp, "
                        "deactivation_date timestamp",
                        [("a", 10.0, DAY, DAY + dt.timedelta(days=3)),
                         ("a", 20.0, DAY + dt.timedelta(hours=23), DAY + dt.timedelta(days=1)),
                         ("b", 5.0, DAY, None)]),
        "recharge": rows("bib_id string, recharge_value_amt double",
                         [("a", 7.0), ("a", 8.0), ("a", 100.0)]),
        "cdr": rows("bib_id string, sms_count int, voice_count int, call_duration double, "
                    "gprs_usage double",
                    [("a", 1, 2, 3.5, None), ("a", None, 2, 1.5, 4.0)]),
        "user": rows("bib_id string, date_of_birth_d date, registration_date_d date, "
                     "contract_type_v string, gender_v string, account_balance double",
                     [("a", dt.date(1974, 1, 1), dt.date(2010, 5, 5), "x", "F", 1.5),
                      ("a", dt.date(1974, 1, 1), dt.date(2010, 5, 5), "x", "F", 1.5),
                      ("b", None, None, None, None, None)]),
    }
    return {t: conform(df, loaded_schema(t)) for t, df in data.items()}


def test_counts_include_null_amounts_and_medians_do_not(tables):
    found = by_key(aggregate_features(tables["loan_assign"], FEATURE_SETS["loan_assign"]))
    assert found == {"a": ("a", 3, 1.5), "b": ("b", 1, None)}


def test_duration_is_in_calendar_days(tables):
    package = with_duration(tables["package"])
    found = by_key(aggregate_features(package, FEATURE_SETS["package"]))
    assert found == {"a": ("a", 2, 15.0, 2.0), "b": ("b", 1, 5.0, None)}


def test_usage_sums(tables):
    found = aggregate_features(tables["cdr"], FEATURE_SETS["cdr"])
    assert by_key(found) == {"a": ("a", 1, 4, 5.0, 4.0)}
    assert [t for _, t in found.dtypes] == ["string", "bigint", "bigint", "double", "double"]


def test_user_attributes_keep_one_row_per_key(tables):
    found = by_key(user_attributes(tables["user"], AS_OF))
    assert set(found) == {"a", "b"}
    key, age, year, *rest = found["a"]
    assert age == pytest.approx(18262 / 365.25) and year == 2010
    assert rest == ["x", "F", None, 1.5]
    assert found["b"] == ("b", None, None, None, None, None, None)


def test_dataset_fills_activity_but_not_user_attributes(tables, rows):
    labels = rows("bib_id string, label int", [("a", 1), ("b", 0), ("c", 0)])
    dataset = modelling_dataset(tables, labels, AS_OF)
    assert dataset.columns == ["bib_id", "label", *AMOUNT_FEATURES, *USAGE_FEATURES, *USER_FEATURES]
    found = {r["bib_id"]: r.asDict() for r in dataset.collect()}
    assert len(found) == dataset.count() == 3
    assert found["a"]["CountPackage"] == 2 and found["a"]["MedianRechargeAmount"] == 8.0
    assert found["b"]["CountAssignLoanAmount"] == 1 and found["b"]["MedianAssignLoanAmount"] == 0.0
    assert all(found["c"][c] == 0 for c in AMOUNT_FEATURES + USAGE_FEATURES)
    assert all(found["c"][c] is None for c in USER_FEATURES)


def test_hot_subscribers_change_nothing(tables, rows):
    labels = rows("bib_id string, label int", [("a", 1), ("b", 0)])
    plain = sorted(modelling_dataset(tables, labels, AS_OF).collect())
    assert sorted(modelling_dataset(tables, labels, AS_OF, hot_rows=1).collect()) == plain


def test_dataset_of_several_months_equals_each_month(tables, rows):
    labels = rows("bib_id string, label int", [("a", 1), ("b", 0)])
    later = {t: df.withColumn("bib_id", F.concat("bib_id", F.lit("2"))) for t, df in tables.items()}
    later_labels = rows("bib_id string, label int", [("a2", 0), ("b2", 1)])
    single = [modelling_dataset(tables, labels, AS_OF).collect(),
              modelling_dataset(later, later_labels, AS_OF).collect()]

    def months(first, second):
        return first.withColumn("month", F.lit("1")).unionByName(
            second.withColumn("month", F.lit("2")))

    both = modelling_dataset(
        {t: months(tables[t], later[t]) for t in TABLES}, months(labels, later_labels), AS_OF,
        ("month", "bib_id"))
    assert sorted(both.drop("month").collect()) == sorted(single[0] + single[1])


def test_star_joins_shuffle_each_input_once(tables, rows):
    labels = rows("bib_id string, label int", [("a", 1)]).groupBy("bib_id").agg(
        F.max("label").alias("label"))
    features = subscriber_features(tables, AS_OF)
    assert exchanges(join_features(labels, features)) == len(TABLES) + 1


def test_empty_tables_give_empty_features(tables, rows):
    empty = {t: df.where("false") for t, df in tables.items()}
    for df in subscriber_features(empty, AS_OF).values():
        assert df.count() == 0


def test_own_feature_set(rows):
    wanted = FeatureSet("n", {"mid": "x"}, {"total": "x"})
    df = rows("k string, x double", [("a", 1.0), ("a", 3.0)])
    assert aggregate_features(df, wanted, ["k"]).first().asDict() == {
        "k": "a", "n": 2, "mid": 2.0, "total": 4.0}
