import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tenura.sources import published
from tenura.sources.lake import Lake, ingest, load_months
from tenura.sources.parquet import read_table, write_table
from tenura.sources.published import (
    Folder,
    manifest,
    missing_partitions,
    publish,
    read_partitions,
    remove_unpublished,
)


def month_rows(spark, month, first, count):
    return spark.range(first, first + count).withColumn("month", F.lit(month))


def held(spark, path, months=None):
    found = {}
    for r in read_partitions(spark, path, "month", months).collect():
        found.setdefault(r["month"], []).append(r["id"])
    return {m: sorted(ids) for m, ids in found.items()}


def test_published_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 3).union(month_rows(spark, "02", 10, 2)), path, "month")
    assert held(spark, path) == {"01": [0, 1, 2], "02": [10, 11]}
    publish(month_rows(spark, "02", 20, 1), path, "month", ["02", "03"], rebalance=True)
    assert held(spark, path) == {"01": [0, 1, 2], "02": [20]}
    assert held(spark, path, ["02", "03"]) == {"02": [20]}
    assert missing_partitions(spark, path, "month", ["01", "02", "03", "04"]) == ["04"]
    # Plain readers see the same rows.
    assert sorted(r["id"] for r in read_table(spark, path).collect()) == [0, 1, 2, 20]
    assert read_partitions(spark, path, "month").dtypes == [("id", "bigint"), ("month", "string")]
    assert manifest(Folder(spark, path))[0] == 2 and not Folder(spark, path).names("_runs")
    with pytest.raises(ValueError, match="no partition"):
        read_partitions(spark, str(tmp_path / "none"), "month")


def test_rows_may_come_from_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 4), path, "month")
    even = read_partitions(spark, path, "month").where("id % 2 = 0")
    publish(even, path, "month", ["01"])
    assert held(spark, path) == {"01": [0, 2]}


def test_partitions_may_stay_in_their_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 2), path, "month")
    publish(month_rows(spark, "a/b", 5, 2), path, "month", ["a/b", "02"], settle=False)
    publish(month_rows(spark, "01", 7, 1), path, "month", settle=False)
    assert held(spark, path) == {"01": [7], "a/b": [5, 6]}


def test_tables_of_plain_partitions_are_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(month_rows(spark, "1", 0, 2).union(month_rows(spark, "2", 4, 1)), path, partition_by=["month"])
    assert held(spark, path) == {"1": [0, 1], "2": [4]}
    publish(month_rows(spark, "2", 9, 1), path, "month")
    assert held(spark, path) == {"1": [0, 1], "2": [9]}


class Stopped(Exception):
    pass


STEPS = ["create", "delete", "move"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_run_stopped_at_any_step_leaves_whole_months(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 3).union(month_rows(spark, "02", 10, 2)), path, "month")
    plain = getattr(Folder, step)

    def stop(self, *args):
        if after:
            plain(self, *args)
        raise Stopped

    monkeypatch.setattr(Folder, step, stop)
    with pytest.raises(Stopped):
        publish(month_rows(spark, "01", 5, 1).union(month_rows(spark, "02", 6, 1)), path, "month")
    monkeypatch.undo()
    former, new = {"01": [0, 1, 2], "02": [10, 11]}, {"01": [5], "02": [6]}
    assert held(spark, path) == (former if step == "create" and not after else new)
    publish(month_rows(spark, "03", 8, 1), path, "month")  # finishes the moves
    plain_rows = sorted(r["id"] for r in read_table(spark, path).collect())
    assert plain_rows == sorted(sum(held(spark, path).values(), []))


def test_rows_that_fail_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 3), path, "month")
    bad = month_rows(spark, "01", 5, 3).where(F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).isNull())
    with pytest.raises(Exception, match="bad"):
        write_table(bad, path, partition_by=["month"], partitions=["01", "02"])
    assert held(spark, path) == {"01": [0, 1, 2]}
    assert missing_partitions(spark, path, "month", ["02"]) == ["02"]
    left = Folder(spark, path).names("_runs")
    assert len(left) == 1
    assert remove_unpublished(spark, path, 0) == []
    assert remove_unpublished(spark, path, time.time() + 60) == left
    assert held(spark, path) == {"01": [0, 1, 2]}


def test_another_writer_is_not_lost(spark, tmp_path, monkeypatch):
    """A version taken meanwhile is read again, and both runs' months are current."""
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 1), path, "month")
    plain, calls = published.manifest, []

    def late(folder):
        found = plain(folder)
        if not calls:
            calls.append(1)
            folder.create("_manifest/000000000002.json", '{"month=01": "_runs/x", "month=09": "_runs/y"}')
        return found

    monkeypatch.setattr(published, "manifest", late)
    published._commit(Folder(spark, path), {"month=02": "_runs/z"})
    assert plain(Folder(spark, path)) == (
        3, {"month=01": "_runs/x", "month=02": "_runs/z", "month=09": "_runs/y"})


KILLED = """
import sys, time
sys.path.insert(0, {repo!r})
from tests.session import local_session
from tenura.sources.published import publish
from pyspark.sql import functions as F

def slow(batches):
    for batch in batches:
        yield batch
        time.sleep(120)

spark = local_session("2")
rows = spark.range(100, 140, 1, 2).mapInPandas(slow, "id long").withColumn("month", F.lit("01"))
publish(rows, {path!r}, "month", ["01", "02"])
"""


def test_a_killed_write_leaves_the_former_month(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(month_rows(spark, "01", 0, 3), path, "month")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    writer = subprocess.Popen(
        [sys.executable, "-c", KILLED.format(repo=repo, path=path)],
        stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL,
    )
    try:
        for _ in range(600):
            if os.path.isdir(os.path.join(path, "_runs")):
                break
            time.sleep(0.1)
        time.sleep(1)
        assert writer.poll() is None, "the write ended before it was killed"
    finally:
        writer.kill()
        writer.wait()
    assert os.path.isdir(os.path.join(path, "_runs"))
    assert held(spark, path) == {"01": [0, 1, 2]}
    publish(month_rows(spark, "01", 7, 2), path, "month")
    assert held(spark, path) == {"01": [7, 8]}


def test_a_failed_ingest_keeps_the_months(spark, tmp_path):
    lake = Lake(str(tmp_path), landing="{root}/{table}_{month}.csv")
    header = "bib_id,date_key,fake_id,nid_hash,sms_count,voice_count,call_duration,gprs_usage,voice_session_cos"
    for month in ("01", "02"):
        (tmp_path / f"cdr_{month}.csv").write_text(f"{header}\nu{month},,,,1,,,,\n")
    ingest(spark, lake, ["01", "02"], ["cdr"])
    (tmp_path / "cdr_02.csv").write_text("other,columns\n1,2\n")
    with pytest.raises(ValueError, match="declared are"):
        ingest(spark, lake, ["01", "02"], ["cdr"])
    rows = load_months(spark, lake, ["01", "02"], ["cdr"])["cdr"].select("bib_id", "month").collect()
    assert sorted(map(tuple, rows)) == [("u01", "01"), ("u02", "02")]
