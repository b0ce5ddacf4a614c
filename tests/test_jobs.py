import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tenura.plans import jobs
from tenura.schemas import raw_schema
from tenura.sources.lake import Lake

MONTHS = ["38", "39", "40"]
AS_OF = dt.date(2024, 4, 1)


def land_month(folder, month, number, rng):
    """CSV files of one month for 60 subscribers, headers in any order."""
    def day():
        return f"2024{number:02d}{rng.randrange(1, 29):02d}"

    def stamp():
        return f"{day()} {rng.randrange(24):02d}:00:00"

    lines = {table: [] for table in ("loan_assign", "loan_recovery", "package", "recharge", "cdr", "user")}
    for i in range(60):
        key = {"bib_id": f"u{i}", "date_key": day(), "nid_hash": f"p{i // 2}"}
        lines["user"].append({
            **key, "contract_type_v": rng.choice("ab"), "gender_v": rng.choice(["F", "M", ""]),
            "registration_date_d": f"20{rng.randrange(10, 20)}0101",
            "date_of_birth_d": f"19{rng.randrange(40, 99)}0101",
            "ability_status": rng.choice("xy"), "account_balance": rng.randrange(-10, 900)})
        for _ in range(rng.randrange(3)):
            lines["package"].append({
                **key, "offer_amount": rng.randrange(100), "activation_date": stamp(),
                "deactivation_date": "20240501 00:00:00"})
            lines["recharge"].append({
                **key, "recharge_value_amt": rng.randrange(500), "recharge_dt": stamp()})
            lines["loan_assign"].append({**key, "loan_id": f"l{i}", "loan_amount": rng.randrange(90)})
            lines["loan_recovery"].append({
                **key, "loan_id": f"l{i}", "loan_amount": 5, "hsdp_recovery": 4})
            lines["cdr"].append({
                **key, "sms_count": rng.randrange(5), "voice_count": 1, "call_duration": rng.random(),
                "gprs_usage": rng.random() * 50})
    for table, rows in lines.items():
        header = raw_schema(table).names
        rng.shuffle(header)
        text = [",".join(header)] + [",".join(str(r.get(c, "")) for c in header) for r in rows]
        (folder / f"{table}_{month}.csv").write_text("\n".join(text) + "\n")


def test_landing_files_to_predictions(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    rng = random.Random(3)
    for number, month in enumerate(MONTHS, start=1):
        land_month(landing, month, number, rng)
    lake = Lake(str(tmp_path))
    grid = {"maxIter": [2], "maxDepth": [2, 3]}
    metrics = jobs.run_all(spark, lake, MONTHS, AS_OF, "gbt", "f1", grid)
    found = dict(metrics.collect())
    assert set(found) == {"accuracy", "f1", "precision", "recall", "auc"}

    labels = spark.read.parquet(lake.result_path("label"))
    assert {str(r["month"]) for r in labels.select("month").distinct().collect()} == {"38", "39"}
    dataset = spark.read.parquet(lake.result_path("dataset"))
    per_month = dict(dataset.groupBy(F.col("month").cast("string")).count().collect())
    assert set(per_month) == set(MONTHS)
    assert dataset.where("month = 40 AND label IS NOT NULL").count() == 0
    assert dataset.where("month < 40 AND label IS NULL").count() == 0
    assert dataset.groupBy("month", "bib_id").count().where("count > 1").count() == 0
    predictions = spark.read.parquet(lake.result_path("predictions/gbt__f1"))
    assert predictions.count() == per_month["40"]
    assert predictions.columns == ["bib_id", "prediction", "month"]

    # Every job can be run again with the same results, and keeps its inputs.
    before = sorted(predictions.collect()), sorted(labels.collect())
    jobs.label_job(spark, lake, MONTHS)
    jobs.dataset_job(spark, lake, MONTHS, AS_OF)
    jobs.preprocess_job(spark, lake, MONTHS)
    assert jobs.train_job(spark, lake, "38", "gbt", "f1", grid) is None
    assert 0 <= jobs.train_job(spark, lake, "38", "gbt", "f1", grid, overwrite=True) <= 1
    assert dict(jobs.evaluate_job(spark, lake, "39", "gbt", "f1").collect()) == pytest.approx(found)
    jobs.score_job(spark, lake, "40", "gbt", "f1")
    after = (
        sorted(spark.read.parquet(lake.result_path("predictions/gbt__f1")).collect()),
        sorted(spark.read.parquet(lake.result_path("label")).collect()),
    )
    assert after == before
    jobs.score_job(spark, lake, "39", "gbt", "f1", probability=True)
    with pytest.raises(ValueError):
        jobs.label_job(spark, lake, ["40", "41"])


def test_months_without_rows_and_rows_without_a_key(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    rng = random.Random(4)
    for number, month in enumerate(MONTHS, start=1):
        land_month(landing, month, number, rng)
    package = landing / "package_38.csv"
    header = package.read_text().splitlines()[0]
    package.write_text(package.read_text() + "," * header.count(",") + "\n")
    lake = Lake(str(tmp_path))
    jobs.ingest_job(spark, lake, MONTHS)
    without = dict(jobs.label_job(spark, lake, MONTHS).collect())
    assert without == {"package": 1, "recharge": 0}
    left_out = jobs.dataset_job(spark, lake, MONTHS, AS_OF)
    assert dict(left_out.collect())["package"] == 1

    # Loans of month 39 vanish: its rows stay, with counts of 0.
    loans = landing / "loan_assign_39.csv"
    loans.write_text(loans.read_text().splitlines()[0] + "\n")
    jobs.ingest_job(spark, lake, ["39"])
    jobs.dataset_job(spark, lake, MONTHS, AS_OF)
    rows = spark.read.parquet(lake.result_path("dataset")).where("month = 39")
    assert rows.count() > 0
    assert rows.where("CountAssignLoanAmount <> 0").count() == 0

    # All activity of month 39 vanishes: no labels and no rows of it stay behind.
    for table in ("package", "recharge"):
        file = landing / f"{table}_39.csv"
        file.write_text(file.read_text().splitlines()[0] + "\n")
    jobs.ingest_job(spark, lake, ["39"])
    jobs.label_job(spark, lake, MONTHS)
    jobs.dataset_job(spark, lake, MONTHS, AS_OF)
    for kind in ("label", "dataset"):
        assert spark.read.parquet(lake.result_path(kind)).where("month = 39").count() == 0
