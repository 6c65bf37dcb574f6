"""Tables stored in the shared folder between steps."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from mercato.plans.session import discard, materialize


def estimated_bytes(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_stored_tables_forget_the_estimate_of_their_plan(spark):
    rows = spark.range(200).select("id", (F.col("id") + 1).alias("next"))
    for _ in range(10):
        following = rows.select(F.col("id").alias("next"), F.col("next").alias("then"))
        rows = materialize(rows.join(following, "next").select("id", F.col("then").alias("next")))
        assert estimated_bytes(rows).bit_length() < 64


def test_any_names_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 2.5, "")], "`a b` int, `A B` double, `c.d;` string")
    back = materialize(df)
    assert back.columns == df.columns and [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert materialize(df.limit(0)).collect() == []


def test_discarded_tables_leave_no_files(spark):
    kept, gone = materialize(spark.range(5)), materialize(spark.range(5))
    discard(gone, None, spark.range(1))
    path = {df: df._mercato_path.removeprefix("file:") for df in (kept, gone)}
    assert os.path.exists(path[kept]) and not os.path.exists(path[gone]) and kept.count() == 5
