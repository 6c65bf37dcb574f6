"""Lookup joins: row counts are kept and guarded, hot keys are spread."""

from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, d, ts
from mercato.operators import enrich
from mercato.operators.lookups import FanOutError, JoinGuard, hot_keys, lookup_join
from mercato.plans.batch import run_batch
from mercato.plans.session import materialize, scratch_path
from mercato.sources.fixtures import load_sources
from oracle_check import compare, duck


def orders(spark, n=3000):
    rng = random.Random(4)
    rows = [(i, rng.choice([7, 8, 8, 8, 8, None, *range(100, 160)]) if i % 3 else 7, rng.random()) for i in range(n)]
    return spark.createDataFrame(rows, "order_id long, customer_id long, value double").repartition(4)


def customers(spark, extra=()):
    rows = [(7, "SP", None), (8, None, "x"), (None, "none", "none"), *[(k, f"s{k}", "c") for k in range(100, 150)], *extra]
    return spark.createDataFrame(rows, "customer_id long, state string, city string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("tasks", [4, 300])
def test_spread_join_equals_the_plain_join(spark, tasks):
    left, right = orders(spark), customers(spark)
    hot = hot_keys(left, "customer_id")
    assert set(hot) >= {7, 8} and 0.3 < hot[7] < 0.6 and None not in hot
    plain = left.join(right, "customer_id", "left").select(*left.columns, "state", "city")
    assert rows_of(lookup_join(left, right, "customer_id", hot=hot, tasks=tasks)) == rows_of(plain)
    assert rows_of(lookup_join(left.limit(0), right, "customer_id", hot=hot, tasks=tasks)) == []
    assert rows_of(lookup_join(left, right.limit(0), "customer_id", hot=hot, tasks=tasks)) == rows_of(
        left.select("*", F.lit(None), F.lit(None))
    )


def test_repeated_lookup_keys_are_named_after_the_one_job(spark):
    guard = JoinGuard("orders to customers")
    right = customers(spark, [(7, "RJ", "z"), (7, "AA", None), (101, "s101", "c")])
    left, reads = orders(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    out = materialize(lookup_join(left.mapInArrow(counted, left.schema), right, "customer_id", guard))
    assert out.count() == 3000 and reads.value == 3000  # no second pass over the orders
    with pytest.raises(FanOutError, match=r"2 keys .* 101 \(2 rows\), 7 \(3 rows\)") as e:
        guard.check()
    assert e.value.audit.rows_in == e.value.audit.rows_out == 3000 and e.value.audit.repeated_keys == 2
    # the least row of a repeated key is taken, in any order
    assert out.filter("customer_id = 7").select("state").distinct().collect() == [("AA",)]


def test_unique_lookup_passes(spark):
    guard = JoinGuard("j")
    materialize(lookup_join(orders(spark), customers(spark), "customer_id", guard, hot={7: 0.4}, tasks=50))
    seen = guard.check()
    assert (seen.rows_in, seen.rows_out, seen.repeated_keys, seen.worst) == (3000, 3000, 0, [])


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="value"):
        lookup_join(orders(spark), customers(spark).withColumnRenamed("city", "value"), "customer_id")


def test_seeded_duplicate_customer_fails_the_batch(spark, raw):
    src_orders = [(1, 10, "delivered", ts("2017-01-02 10:00:00"), ts("2017-01-05 10:00:00"), ts("2017-01-09 00:00:00"))]
    tables = raw(src_orders, customers=[(10, "SP", "a"), (10, "SP", "b")], payments=[(1, 1, 5.0)], weather=[(d("2017-01-02"), 20.0, 0.0)])
    guards = enrich.OrderGuards()
    full = materialize(enrich.orders_full(*(tables[k] for k in ("orders", "customers", "payments", "order_items", "weather")), guards))
    assert full.count() == 1
    with pytest.raises(FanOutError, match=r"10 \(2 rows\)"):
        guards.check()


def test_batch_stops_before_it_loads(spark):
    src = load_sources(spark, SF_SMALL)
    src = dataclasses.replace(src, customers=src.customers.unionByName(src.customers.limit(1)))
    with pytest.raises(FanOutError, match="orders to customers: 1 keys"):
        run_batch(spark, src, scratch_path(spark, "fan-out"), "2020-01-01T00:00:00", database="mercato_fan_out")
    assert spark.catalog.listTables("mercato_fan_out") == []
    spark.sql("DROP DATABASE mercato_fan_out CASCADE")


@pytest.mark.parametrize("name", ["join_row_audit", "join_states_spread", "join_customers", "orders_full"])
def test_queries_against_the_oracle(spark, name):
    import __spark_entry__ as E
    from conftest import SF_CHECK

    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r


def test_checked_in_tasks_show_the_hot_key_spread():
    """Join tasks of tests/hot_key_report.py: a customer with a third of 64,710 orders."""
    import json
    from pathlib import Path

    def read(name):
        lines = (Path(__file__).parent / "hot_key_tasks" / f"{name}.jsonl").read_text().splitlines()
        return sorted(json.loads(x)["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for x in lines)

    plain, spread = read("plain"), read("spread")
    assert plain[-1] > sum(plain) / 4 and spread[-1] < 4 * spread[len(spread) // 2] and len(spread) == 64
