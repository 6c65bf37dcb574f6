"""Catalog tables are replaced in one step."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_CHECK
from mercato.sources.versions import KEPT, replace_table
from oracle_check import compare, duck

NAME = "versions_test.numbers"


@pytest.fixture
def folder(spark, tmp_path):
    spark.sql(f"CREATE DATABASE versions_test LOCATION '{tmp_path}/db'")
    yield str(tmp_path / "numbers")
    spark.sql("DROP DATABASE versions_test CASCADE")


def ids(spark):
    return sorted(r.id for r in spark.table(NAME).collect())


def numbers(spark, n, start=0):
    return spark.range(start, start + n, 1, 4).withColumn("month", F.col("id") % 3)


def test_a_failed_write_leaves_the_old_table(spark, folder):
    assert replace_table(numbers(spark, 10), NAME, folder) == 10
    halfway = numbers(spark, 100).withColumn("id", F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")))
    with pytest.raises(Exception, match="stop"):
        replace_table(halfway, NAME, folder)

    def refuse():
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_table(numbers(spark, 5), NAME, folder, check=refuse)
    assert ids(spark) == list(range(10)) and len(os.listdir(folder)) == 1


def test_readers_of_the_version_before_can_end(spark, folder):
    replace_table(numbers(spark, 4), NAME, folder)
    reading = spark.table(NAME)
    reading.schema  # planned before the table is replaced
    replace_table(numbers(spark, 3, 50), NAME, folder)
    assert sorted(r.id for r in reading.collect()) == [0, 1, 2, 3] and ids(spark) == [50, 51, 52]
    replace_table(numbers(spark, 2, 70), NAME, folder)
    assert ids(spark) == [70, 71] and len(os.listdir(folder)) == KEPT


def test_partitions_and_columns_may_change(spark, folder):
    replace_table(numbers(spark, 9), NAME, folder, ["month"])
    assert spark.table(NAME).filter("month = 1").count() == 3
    scan = spark.table(NAME).filter("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan
    replace_table(numbers(spark, 6).withColumn("name", F.lit("x")), NAME, folder, ["month"])
    assert spark.table(NAME).columns == ["id", "month", "name"] and spark.table(NAME).count() == 6


def test_a_plain_table_of_the_name_is_taken_over(spark, folder):
    numbers(spark, 2).write.saveAsTable(NAME)
    replace_table(numbers(spark, 5), NAME, folder)
    assert len(ids(spark)) == 5


def test_query_against_the_oracle(spark):
    name = "sink_table_replaced"
    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r
