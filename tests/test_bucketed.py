"""Activity tables bucketed by key."""

import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tenura.operators.activity import (
    activity_bounds_of_summaries,
    churn_labels,
    churn_labels_of_summaries,
)
from tenura.sources.bucketed import read_activity, write_activity
from tests.plans import exchanges

MONTHS = ["38", "39", "40"]


def day(n, hour=0):
    return datetime.datetime(2024, 1, 1, hour) + datetime.timedelta(days=n)


@pytest.fixture()
def activity(rows):
    data = [
        ("38", "back", day(3)), ("38", "back", day(1)), ("39", "back", day(20)),
        ("38", "late", day(2)), ("39", "late", day(55)), ("39", "late", None),
        ("38", "gone", day(5)), ("40", "gone", day(70)),
        ("38", "undated", None), ("39", "undated", None),
        ("38", None, day(1)),
        *(("38" if i % 2 else "39", "hot", day(i % 28 + 30 * (1 - i % 2))) for i in range(3000)),
    ]
    return rows("month string, bib_id string, ts timestamp", data)


def labels(df):
    return sorted((r["month"], r["bib_id"], r["label"]) for r in df.collect())


def test_labels_equal_those_of_rows_without_an_exchange(spark, activity, tmp_path):
    write_activity(activity, str(tmp_path), MONTHS, 4)
    found = churn_labels_of_summaries(read_activity(spark, str(tmp_path), MONTHS, 4), MONTHS)
    assert labels(found) == labels(churn_labels(activity.where("bib_id IS NOT NULL"), MONTHS))
    assert ("38", "undated", 0) in labels(found) and ("38", "late", 1) in labels(found)
    assert exchanges(found) == 0
    assert "Bucketed: true" in found._jdf.queryExecution().executedPlan().toString()


def test_bounds_need_no_exchange(spark, activity, tmp_path):
    write_activity(activity, str(tmp_path), MONTHS, 4)
    found = activity_bounds_of_summaries(read_activity(spark, str(tmp_path), ["38", "39"], 4))
    assert exchanges(found) == 0
    rows = {r["bib_id"]: tuple(r)[1:] for r in found.collect()}
    assert rows["back"] == (day(1), day(20), 3)
    assert rows["undated"] == (None, None, 2)
    assert rows["hot"][2] == 3000
    assert rows["gone"] == (day(5), day(5), 1)


def test_a_hot_key_is_one_row_per_month(spark, activity, tmp_path):
    write_activity(activity, str(tmp_path), MONTHS, 4)
    summary = read_activity(spark, str(tmp_path), MONTHS, 4)
    assert summary.where("bib_id = 'hot'").count() == 2


def test_months_are_replaced_one_by_one(spark, activity, tmp_path):
    path = str(tmp_path)
    write_activity(activity, path, MONTHS, 4)
    write_activity(activity.where("month = '39' AND bib_id = 'back'"), path, ["39"], 4)
    write_activity(activity.where("false"), path, ["40"], 4)
    left = read_activity(spark, path, MONTHS, 4).groupBy("month").agg(F.count("bib_id").alias("n"))
    assert {r["month"]: r["n"] for r in left.collect()} == {"38": 5, "39": 1}


def test_months_never_written_and_months_not_named(spark, activity, tmp_path):
    path = str(tmp_path)
    write_activity(activity.where("month = '38'"), path, ["38"], 4)
    with pytest.raises(ValueError, match="39"):
        read_activity(spark, path, ["38", "39"], 4)
    with pytest.raises(SparkRuntimeException, match="not written"):
        write_activity(activity, path, ["38"], 4)
    assert read_activity(spark, path, ["38"], 4).count() == 5


def test_another_session_finds_the_table(spark, activity, tmp_path):
    write_activity(activity, str(tmp_path), MONTHS, 4)
    other = spark.newSession()
    for table in other.catalog.listTables():
        if table.name.startswith("activity_"):
            other.sql(f"DROP TABLE {table.name}")
    assert read_activity(other, str(tmp_path), MONTHS, 4).where("bib_id = 'back'").count() == 2


def test_empty_activity(spark, activity, tmp_path):
    write_activity(activity.where("false"), str(tmp_path), MONTHS, 4)
    summary = read_activity(spark, str(tmp_path), MONTHS, 4)
    assert churn_labels_of_summaries(summary, MONTHS).count() == 0
