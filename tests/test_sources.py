import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tenura.catalog import sources as catalog_sources
from tenura.schemas import TABLES, conform, loaded_schema, raw_schema
from tenura.sources import shared
from tenura.sources.csv import read_csv, read_landing_table
from tenura.sources.lake import Lake, ingest, load_activity, load_months
from tenura.sources.parquet import is_complete, mark_complete, path_exists, read_table, write_table

RECHARGE = [
    "bib_id", "date_key", "fake_id", "nid_hash", "recharge_value_amt", "recharge_dt",
    "origin_host_nm", "account_balance_before_amt", "account_balance_after_amt",
]


def write_csv(path, header, *lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def recharge_line(header, **values):
    return ",".join(str(values.get(c, "")) for c in header)


def test_schemas(spark):
    assert len(TABLES) == 6
    assert raw_schema("recharge").names == RECHARGE
    assert raw_schema("cdr")["sms_count"].dataType.simpleString() == "int"
    assert not raw_schema("user")["bib_id"].nullable
    assert loaded_schema("package")["activation_date"].dataType.simpleString() == "timestamp"
    assert loaded_schema("user")["date_of_birth_d"].dataType.simpleString() == "date"
    assert loaded_schema("user").names == raw_schema("user").names


def test_csv_values_follow_header_names(spark, tmp_path):
    header = RECHARGE[::-1]
    path = write_csv(tmp_path / "a.csv", header, recharge_line(
        header, bib_id="u1", recharge_value_amt=5.5, recharge_dt="20240131 10:00:00",
        date_key="20240131", origin_host_nm="h", account_balance_before_amt=1,
        account_balance_after_amt=6.5))
    row = read_landing_table(spark, "recharge", path).first()
    assert row.asDict() == {
        "bib_id": "u1", "date_key": dt.date(2024, 1, 31), "fake_id": None, "nid_hash": None,
        "recharge_value_amt": 5.5, "recharge_dt": dt.datetime(2024, 1, 31, 10),
        "origin_host_nm": "h", "account_balance_before_amt": 1.0,
        "account_balance_after_amt": 6.5,
    }


def test_csv_header_orders_may_differ_between_files(spark, tmp_path):
    schema = raw_schema("recharge")
    paths = [
        write_csv(tmp_path / f"{i}.csv", header,
                  recharge_line(header, bib_id=f"u{i}", recharge_value_amt=i))
        for i, header in enumerate([RECHARGE, RECHARGE[::-1], RECHARGE])
    ]
    found = read_csv(spark, paths, schema).select("bib_id", "recharge_value_amt").collect()
    assert sorted(map(tuple, found)) == [("u0", 0.0), ("u1", 1.0), ("u2", 2.0)]


@pytest.mark.parametrize("header", [RECHARGE[:-1], [*RECHARGE, "more"], [*RECHARGE[:-1], "other"]])
def test_csv_with_other_columns_is_refused(spark, tmp_path, header):
    path = write_csv(tmp_path / "bad.csv", header)
    with pytest.raises(ValueError, match="declared are"):
        read_csv(spark, path, raw_schema("recharge"))


def test_csv_folder_with_mixed_headers_is_refused_at_the_scan(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    for name, header in (("1", RECHARGE), ("2", RECHARGE[::-1])):
        write_csv(folder / f"{name}.csv", header, recharge_line(header, bib_id=name))
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(folder), raw_schema("recharge")).collect()


def test_malformed_and_empty_csv(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", RECHARGE, recharge_line(
        RECHARGE, bib_id="u1", recharge_value_amt="much", recharge_dt="2024x"))
    row = read_landing_table(spark, "recharge", path).first()
    assert (row["recharge_value_amt"], row["recharge_dt"]) == (None, None)
    empty = read_landing_table(spark, "recharge", write_csv(tmp_path / "e.csv", RECHARGE))
    assert empty.count() == 0 and empty.schema.names == RECHARGE


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    write_table(df, path)
    write_table(df, path, "append")
    write_table(df, path, "ignore")
    assert read_table(spark, path).count() == 6
    with pytest.raises(Exception, match="exist"):
        write_table(df, path, "error")
    write_table(df, path)
    assert read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        write_table(df, path, "upsert")
    assert path_exists(spark, path) and not path_exists(spark, path + "-not")


def test_overwriting_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("month", (F.col("id") % 2).cast("string"))
    write_table(df, path, partition_by=["month"], rebalance=True)
    write_table(df.where("month = '1' AND id > 5"), path, partition_by=["month"])
    assert dict(read_table(spark, path).groupBy("month").count().collect()) == {0: 5, 1: 2}


@pytest.fixture()
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path), landing="{root}/{table}_{month}.csv")
    for month in ("01", "02"):
        for table in TABLES:
            header = raw_schema(table).names
            write_csv(tmp_path / f"{table}_{month}.csv", header,
                      recharge_line(header, bib_id=f"u{month}"))
    return lake


def test_ingest_and_load_months(spark, lake):
    ingest(spark, lake, ["01", "02"])
    ingest(spark, lake, ["02"])
    both = load_months(spark, lake, ["01", "02"])
    assert set(both) == set(TABLES)
    for table, df in both.items():
        assert df.drop("month").schema.simpleString() == loaded_schema(table).simpleString()
        assert sorted(r["month"] for r in df.collect()) == ["01", "02"]
    only = load_activity(spark, lake, ["01"])
    assert set(only) == {"package", "recharge"}
    assert [r["bib_id"] for r in only["package"].collect()] == ["u01"]
    plan = only["package"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    with pytest.raises(ValueError, match="03"):
        load_months(spark, lake, ["01", "03"])


def test_a_month_that_becomes_empty(spark, lake, tmp_path):
    ingest(spark, lake, ["01", "02"])
    for table in TABLES:
        (tmp_path / f"{table}_02.csv").write_text(",".join(raw_schema(table).names) + "\n")
    ingest(spark, lake, ["02"])
    for table, df in load_months(spark, lake, ["01", "02"]).items():
        assert [r["month"] for r in df.collect()] == ["01"], table
        assert df.where("month = '02'").count() == 0


def test_named_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("month", (F.col("id") % 2).cast("string"))
    write_table(df, path, partition_by=["month"])
    write_table(df.where("month = '0'"), path, partition_by=["month"], partitions=["0", "1"])
    assert dict(read_table(spark, path).groupBy("month").count().collect()) == {0: 5}
    assert path_exists(spark, f"{path}/month=1")


def test_old_dates_are_read_as_written(spark, tmp_path):
    """Dates before the calendar reform come back from Parquet unchanged."""
    path = str(tmp_path / "old")
    spark.sql("SELECT DATE'1500-01-01' AS d, TIMESTAMP'1500-01-01 00:00:00' AS t").write.parquet(path)
    row = spark.read.parquet(path).selectExpr("CAST(d AS STRING) d", "CAST(t AS STRING) t").first()
    assert tuple(row) == ("1500-01-01", "1500-01-01 00:00:00")


def test_a_model_folder_counts_when_it_is_whole(spark, tmp_path):
    folder = tmp_path / "model"
    folder.mkdir()
    assert not is_complete(spark, str(folder))
    mark_complete(spark, str(folder))
    assert is_complete(spark, str(folder))


def test_conform(rows):
    found = conform(rows("sms_count long, bib_id int", [(1, 7)]), loaded_schema("cdr"))
    assert found.schema.simpleString() == loaded_schema("cdr").simpleString()
    assert found.select("bib_id", "sms_count", "gprs_usage").first() == ("7", 1, None)


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or shared.shared_folder(spark) == folder
    cut = shared.cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert cut.count() == 5
    assert shared.new_path(spark, "a") != shared.new_path(spark, "a")
    assert shared.materialize(spark.range(4), "four").count() == 4


def test_tables_of_a_lake_are_written_together(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(catalog_sources, "write_table", lambda *args, **named: both.wait())
    catalog_sources.build_lake(spark, "/root/testdata/sf0.001", ["package", "recharge"])


def test_landing_of_all_tables_is_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog_sources, "new_path", lambda spark, name: str(tmp_path / name))
    catalog_sources.csv_to_parquet(spark, "/root/testdata/sf0.001")
    landed = [p.name for p in (tmp_path / "lake" / "landing").rglob("part-*")]
    assert landed and all(name.endswith(".csv.gz") for name in landed)
