"""Cells of landing files that can't be read."""

import pytest

from tenura.sources.csv import read_landing_table, rejected_cells
from tenura.sources.lake import Lake, ingest, load_months, load_rejects

HEADER = "date_key,bib_id,sms_count,voice_count,fake_id,nid_hash,call_duration,gprs_usage,voice_session_cos"
LINES = [
    "20240101,a,1,2,,,3.5,4.5,0",
    "20240101,b,one,2,,,3.5,,0",
    "20249901,c,1,2,,,3.5,4.5,0",
    '20240101,"d,e",1.5,x,,,"3,5",4.5,0',
    "20240101,f,1,2,,,3.5,4.5,0,extra",
    "20240101,g,1",
    ",h,,,,,,,",
]


def write(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def cells(df):
    return sorted((r["column"] or "", r["text"]) for r in df.collect())


def test_every_unreadable_cell_is_listed(spark, tmp_path):
    path = write(tmp_path / "cdr_38.csv", LINES)
    found = rejected_cells(spark, "cdr", path)
    assert found.columns == ["file", "column", "text"]
    assert cells(found) == sorted([
        ("sms_count", "one"), ("date_key", "20249901"),
        ("sms_count", "1.5"), ("voice_count", "x"), ("call_duration", "3,5"),
        ("", LINES[4]), ("", LINES[5]),
    ])
    assert all(r["file"].endswith("/cdr_38.csv") for r in found.collect())


def test_what_is_rejected_is_what_is_null(spark, tmp_path):
    path = write(tmp_path / "cdr_38.csv", LINES[:5])
    rows = {r["bib_id"]: r for r in read_landing_table(spark, "cdr", path).collect()}
    for column, keys in {"sms_count": "bd", "date_key": "c", "voice_count": "d", "call_duration": "d"}.items():
        assert {k[0] for k, r in rows.items() if r[column] is None} == set(keys)


def test_files_with_other_header_orders(spark, tmp_path):
    first = write(tmp_path / "one.csv", LINES[:2])
    order = HEADER.split(",")[::-1]
    second = write(tmp_path / "two.csv", ["0,bad,3.5,,,2,1,k,20240101"], ",".join(order))
    found = rejected_cells(spark, "cdr", [first, second])
    assert sorted((r["file"][-7:], r["column"], r["text"]) for r in found.collect()) == [
        ("one.csv", "sms_count", "one"), ("two.csv", "gprs_usage", "bad")]


def test_clean_and_empty_files_have_no_rejects(spark, tmp_path):
    assert rejected_cells(spark, "cdr", write(tmp_path / "a.csv", LINES[:1])).count() == 0
    assert rejected_cells(spark, "cdr", write(tmp_path / "b.csv", [])).count() == 0


def test_rejects_are_published_by_month(spark, tmp_path):
    lake = Lake(str(tmp_path))
    (tmp_path / "landing").mkdir()
    write(tmp_path / "landing" / "cdr_38.csv", LINES[:2])
    write(tmp_path / "landing" / "cdr_39.csv", LINES[:4])
    ingest(spark, lake, ["38", "39"], ["cdr"], rejects=True)
    rejects = load_rejects(spark, lake, ["38", "39"], ["cdr"])
    assert {(r["month"], r["count"]) for r in rejects.groupBy("month").count().collect()} == {("38", 1), ("39", 5)}
    assert {r["source"] for r in rejects.collect()} == {"cdr"}
    write(tmp_path / "landing" / "cdr_39.csv", LINES[:1])
    ingest(spark, lake, ["39"], ["cdr"], rejects=True)
    assert load_rejects(spark, lake, ["39"], ["cdr"]).count() == 0
    assert load_rejects(spark, lake, ["38"], ["cdr"]).count() == 1
    assert load_months(spark, lake, ["39"], ["cdr"])["cdr"].count() == 1
    with pytest.raises(ValueError, match="40"):
        load_rejects(spark, lake, ["40"], ["cdr"])
