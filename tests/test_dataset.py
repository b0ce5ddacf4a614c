import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tenura.operators.activity import churn_labels, package_recharge_activity, scoring_population
from tenura.operators.dataset import labelled_dataset, population_dataset, table_sources
from tenura.operators.features import join_features, modelling_dataset, subscriber_features
from tenura.schemas import TABLES, conform, loaded_schema
from tests.plans import final_plan

AS_OF = dt.date(2024, 6, 1)
MONTHS = ["01", "02", "03"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Six Parquet tables of three months, with null keys, null dates, NaN and repeated users."""
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("tables")

    def day(month):
        return rng.choice([None, dt.datetime(2024, int(month), rng.randrange(1, 29), rng.randrange(24))])

    data = {name: [] for name in TABLES}
    for month in MONTHS:
        for _ in range(150):
            key = rng.choice([None, *(f"u{i}" for i in range(25))])
            at = day(month)
            later = None if at is None else at + dt.timedelta(days=rng.randrange(9))
            money = rng.choice([None, float("nan"), *(float(rng.randrange(50)) for _ in range(6))])
            name = rng.choice(TABLES)
            data[name].append({
                "loan_assign": (month, key, money), "loan_recovery": (month, key, money),
                "package": (month, key, money, at, later), "recharge": (month, key, money, at),
                "cdr": (month, key, rng.choice([None, 3]), rng.randrange(4), money, 1.5),
                "user": (month, key, rng.choice([None, dt.date(1980, 1, rng.randrange(1, 20))]),
                         rng.choice([None, dt.date(2015, 1, 1)]), rng.choice(["a", None]), money),
            }[name])
    columns = {
        "loan_assign": "loan_amount double", "loan_recovery": "loan_amount double",
        "package": "offer_amount double, activation_date timestamp, deactivation_date timestamp",
        "recharge": "recharge_value_amt double, recharge_dt timestamp",
        "cdr": "sms_count int, voice_count int, call_duration double, gprs_usage double",
        "user": "date_of_birth_d date, registration_date_d date, contract_type_v string, account_balance double",
    }
    found = {}
    for name in TABLES:
        rows = spark.createDataFrame(data[name], f"month string, bib_id string, {columns[name]}")
        schema = loaded_schema(name).add("month", "string")
        conform(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def star(tables, population, keys):
    """The dataset by joins of one aggregate per table."""
    return join_features(population, subscriber_features(tables, AS_OF, keys), keys)


def labels(tables, months):
    keys = ("month", "bib_id")
    activity = package_recharge_activity(tables["package"], tables["recharge"], keys)
    known = churn_labels(activity, months)
    last = [tables[t].where(F.col("month") == months[-1]) for t in ("package", "recharge")]
    return known.unionByName(scoring_population(last, keys))


def collected(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("hot_rows", [200_000, 5])
def test_one_pass_equals_labels_and_joins(tables, hot_rows):
    expected = star(tables, labels(tables, MONTHS), ("month", "bib_id"))
    found = labelled_dataset(table_sources(tables), MONTHS, AS_OF, hot_rows=hot_rows)
    assert found.schema.simpleString() == expected.schema.simpleString()
    rows = collected(found)
    assert rows == collected(expected) and len(rows) > 40
    first = labelled_dataset(table_sources(tables), MONTHS, AS_OF, wanted=["01"], hot_rows=hot_rows)
    assert collected(first) == [r for r in rows if r.startswith("('01'")]


def test_labelled_months_must_be_known(tables):
    with pytest.raises(ValueError, match="04"):
        labelled_dataset(table_sources(tables), MONTHS, AS_OF, wanted=["04"])


def test_population_of_any_keys(tables, spark):
    population = spark.createDataFrame([("u1", 1), ("u2", 0), ("nobody", 1), ("u3", None)], "bib_id string, label int")
    expected = star(tables, population, ("bib_id",))
    assert collected(modelling_dataset(tables, population, AS_OF)) == collected(expected)
    everyone = scoring_population([tables["package"], tables["recharge"]])
    found = population_dataset(table_sources(tables), None, AS_OF)
    assert collected(found) == collected(star(tables, everyone, ("bib_id",)))


def test_sources_of_several_kinds(tables):
    """Loans and their recoveries in one table, told apart by a condition."""
    both = tables["loan_assign"].select("bib_id", "loan_amount", F.lit(True).alias("given")).unionByName(
        tables["loan_recovery"].select("bib_id", "loan_amount", F.lit(False).alias("given")))
    rest = [(tables[t], {t: None}) for t in TABLES if not t.startswith("loan")]
    mixed = [(both, {"loan_assign": "given", "loan_recovery": "NOT given"}), *rest]
    plain = population_dataset(table_sources(tables), None, AS_OF)
    assert collected(population_dataset(mixed, None, AS_OF)) == collected(plain)


def test_each_file_is_scanned_once_and_shuffled_once(tables, spark):
    population = spark.createDataFrame([("u1", 1)], "bib_id string, label int")
    for df in (
        labelled_dataset(table_sources(tables), MONTHS, AS_OF),
        population_dataset(table_sources(tables), None, AS_OF),
        modelling_dataset(tables, population, AS_OF),
    ):
        plan = final_plan(df)
        assert plan.count("FileScan parquet") == len(TABLES)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "Join" not in plan


def test_only_used_columns_are_read(tables):
    plan = final_plan(labelled_dataset(table_sources(tables), MONTHS, AS_OF))
    assert "origin_host_nm" not in plan and "nid_hash" not in plan


def test_empty_tables(tables):
    empty = {t: df.where("false") for t, df in tables.items()}
    assert labelled_dataset(table_sources(empty), MONTHS, AS_OF).collect() == []
