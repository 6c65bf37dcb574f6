"""Quoted line breaks read by byte ranges, against the one-task reader."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from mercato.sources.io import read_csv, write_csv
from mercato.sources.quoted import _lines, _records, ranges_inside_quotes, read_quoted_csv
from oracle_check import compare, duck
from pyspark.sql import types as T

SCHEMA = T.StructType().add("id", "long").add("text", "string").add("score", "double")


@pytest.fixture
def small_ranges(spark):
    def of(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def hostile(seed, n, end):
    rng = random.Random(seed)
    parts = ["", "plain", "a, b", 'say ""hi""', '""', '""""', "line" + end + "break", end, end + end, ",", "é€𝄞", "x" * 70, '"",""' + end + '1,"']
    out = ["id,text,score"]
    for i in range(n):
        text = "".join(rng.choice(parts[:-1]) for _ in range(rng.randint(0, 5)))
        quoted = f'"{text}"' if text or rng.random() < 0.5 else ""
        out.append(f"{i},{quoted},{'' if rng.random() < 0.2 else i / 4}")
        if rng.random() < 0.05:
            out.append("")
    return end.join(out) + (end if seed % 2 else "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,end,size", [(1, "\n", 37), (2, "\n", 64), (3, "\n", 500), (4, "\r\n", 80), (5, "\n", 1 << 20)])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_ranges, seed, end, size):
    for k in range(2):
        (tmp_path / f"f {k}.csv").write_bytes(hostile(seed + 10 * k, 150, end).encode())
    want = rows(read_csv(spark, str(tmp_path), SCHEMA, multi_line=True))
    small_ranges(size)
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA).collect()
    # line ends inside quotes stay as they are; the other reader makes them \\n
    got = [(r.id, r.text and r.text.replace("\r\n", "\n"), r.score) for r in got]
    assert sorted(got, key=str) == want and len(want) == 300
    if size < 1000:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8


def test_several_tasks_share_a_file_and_records_span_ranges(spark, tmp_path, small_ranges):
    text = "\n".join(["word"] * 400)
    (tmp_path / "one.csv").write_text('id,text,score\n1,"' + text + '",0.5\n2,"b\n\nc",\n')
    small_ranges(100)
    lines = _lines(spark, str(tmp_path))
    inside = ranges_inside_quotes(lines)
    assert len(inside) > 10 and len({r.start for r in _records(lines, inside, False, True).collect()}) > 10
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA)
    assert rows(got) == [(1, text, 0.5), (2, "b\n\nc", None)]


def test_headers_and_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('score,more,text,id\n1.5,x,"t\nu",7\n')
    assert rows(read_quoted_csv(spark, str(tmp_path), SCHEMA)) == [(7, "t\nu", 1.5)]
    (tmp_path / "a.csv").write_text("score,text\n")
    with pytest.raises(ValueError, match="no column id"):
        read_quoted_csv(spark, str(tmp_path), SCHEMA)
    (tmp_path / "a.csv").write_text("id,text,score\nx,y,z\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_quoted_csv(spark, str(tmp_path), SCHEMA).collect()
    (tmp_path / "a.csv").write_text("id,text,score\n")
    assert rows(read_quoted_csv(spark, str(tmp_path), SCHEMA)) == []


def test_round_trip_without_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q "x"\n,', 1.0), (2, None, None), (3, "", 2.0)], SCHEMA)
    write_csv(df, str(tmp_path / "t"), header=False)
    assert rows(read_quoted_csv(spark, str(tmp_path / "t"), SCHEMA, header=False, empty_text=True)) == rows(df)


def test_query_against_the_oracle(spark):
    name = "scan_csv_quoted"
    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r
