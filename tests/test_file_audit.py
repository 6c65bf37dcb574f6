"""Audit of a folder of CSV files with files that can't be read."""

from __future__ import annotations

import gzip

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from mercato.operators.file_audit import audit_csv_folder
from oracle_check import compare, duck


@pytest.fixture
def folder(tmp_path):
    good = "id,amount,name,flag\n1,2.5,x,true\n2,,\"a, b\",false\n3,1e2,y\n"
    (tmp_path / "orders one.csv").write_text(good)
    (tmp_path / "more+one.csv").write_text("amount,id,id\n0.25,7,1\nNA,8,2\n")
    (tmp_path / "zipped.csv.gz").write_bytes(gzip.compress(b"id\n10\n20\n"))
    whole = gzip.compress(("id\n" + "\n".join(map(str, range(200_000)))).encode())
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "not_zipped.csv.gz").write_bytes(b"id\n1\n")
    (tmp_path / "ragged.csv").write_text("id,amount\n1,1\n2,2,2,2\n3,3,3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header_only.csv").write_text("id,amount\n")
    (tmp_path / "words.csv").write_text("id,amount\none,1d\n")
    (tmp_path / "notes.txt").write_text("id\n5\n")
    return tmp_path


def test_broken_files_are_reported_and_the_others_counted(spark, folder):
    rows = audit_csv_folder(spark, str(folder)).collect()
    totals = {(r.column_name, r.source): r.total for r in rows if r.column_name}
    assert totals == {
        ("id", "orders one.csv"): 6.0, ("id", "more+one.csv"): 15.0, ("id.1", "more+one.csv"): 3.0, ("id", "zipped.csv.gz"): 30.0,
        ("amount", "orders one.csv"): 102.5, ("amount", "more+one.csv"): 0.25,
        ("id", None): 51.0, ("id.1", None): 3.0, ("amount", None): 102.75,
    }
    counts = {r.source: r.n_rows for r in rows if r.n_rows is not None}
    assert counts == {"orders one.csv": 3, "more+one.csv": 2, "zipped.csv.gz": 2, "words.csv": 1, None: 8}
    errors = {r.source: r.error for r in rows if r.error}
    assert set(errors) == {"cut.csv.gz", "not_zipped.csv.gz", "ragged.csv", "empty.csv"}
    assert errors["ragged.csv"] == "2 lines have more fields than the header" and errors["empty.csv"] == "empty file"
    assert errors["cut.csv.gz"].startswith("unreadable:") and len(rows) == len(totals) + len(counts) + len(errors)


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"part{k}.csv").write_text(f"a,b\n{k},1\n")
    rows = audit_csv_folder(spark, str(tmp_path)).collect()
    assert {r.total for r in rows if r.column_name == "a" and r.source is None} == {435.0}
    assert sum(r.n_rows or 0 for r in rows if r.source) == 30


def test_plain_files_are_not_read_whole(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a\n" + "1\n" * 500)
    (tmp_path / "short.csv.gz").write_bytes(gzip.compress(b"a\n1\n"))
    name = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(name, "200")  # a longer file can't be read whole
    try:
        rows = audit_csv_folder(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(name)
    assert {r.source: r.total for r in rows if r.column_name} == {"long.csv": 500.0, "short.csv.gz": 1.0, None: 501.0}
    assert not [r for r in rows if r.error]


def test_query_against_the_oracle(spark):
    name = "audit_csv_files"
    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r
