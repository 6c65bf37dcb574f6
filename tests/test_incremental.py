"""Marts kept up month by month equal marts built anew."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from mercato.functions.median import exact_median
from mercato.operators import incremental, marts
from oracle_check import compare, duck

SCHEMA = (
    "order_id long, customer_state string, total_payment double, delivery_days int, item_count long, was_late int, year int, month int"
)


def orders(spark, seed, n=4000, months=((2017, 1), (2017, 2), (2018, 1), (None, None))):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        year, month = rng.choice(months)
        state = rng.choice(["SP", "SP", "SP", "RJ", "MG", None])
        paid = rng.choice([rng.randint(1, 10**7) / 100, 1999.5, 0.0049, None])
        rows.append((i, state, paid, rng.choice([None, 1, 5, 30]), rng.randint(0, 4), rng.randint(0, 1), year, month))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same(spark, folder, table):
    assert rows(incremental.monthly_mart(spark, folder)) == rows(marts.monthly_revenue_mart(table))
    assert rows(incremental.state_mart(spark, folder)) == rows(marts.revenue_by_state_mart(table))


def test_replaced_added_and_emptied_months(spark, tmp_path):
    old, new, folder = orders(spark, 1), orders(spark, 2), str(tmp_path / "parts")
    incremental.refresh(old, [(2017, 1), (2017, 2), (2018, 1), (None, None)], folder)
    same(spark, folder, old)
    table = old.where("month = 1 or month is null").unionByName(new.where("month = 2"))
    incremental.refresh(table, [(2017, 2)], folder)
    same(spark, folder, table)
    more = table.where("year = 2017 or year is null").unionByName(orders(spark, 3, 500, ((2018, 3),)))
    incremental.refresh(more, [(2018, 1), (2018, 3)], folder)  # one is empty now, one is new
    same(spark, folder, more)


def test_only_changed_months_are_read(spark, tmp_path):
    orders(spark, 4).write.partitionBy("year", "month").parquet(str(tmp_path / "stg"))
    stored = spark.read.schema(SCHEMA).parquet(str(tmp_path / "stg"))
    changed = incremental._of_months(stored, [(2017, 2)])
    assert {r.f.split("stg/")[1].rsplit("/", 1)[0] for r in changed.selectExpr("_metadata.file_path as f").distinct().collect()} == {"year=2017/month=2"}
    plan = incremental.month_sums(changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "numPartitions" not in plan


def test_weighted_median_is_that_of_the_rows(spark):
    counted = spark.createDataFrame([("a", 1.0, 3), ("a", 9.0, 2), ("a", 2.0, 1), ("b", 5.0, 2), ("b", 6.0, 2)], "k string, v double, n long")
    got = {r.k: r.median for r in exact_median(counted, ["k"], "v", width=4.0, weight="n").collect()}
    assert got == {"a": 1.5, "b": 5.5}


@pytest.mark.parametrize("name", ["table_mart_refreshed", "state_mart_refreshed"])
def test_queries_against_the_oracle(spark, name):
    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r
