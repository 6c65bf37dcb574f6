"""All rules of a table in one pass."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK, SF_SMALL
from mercato.operators import quality, rule_pass
from mercato.operators.rule_pass import TableRules
from oracle_check import compare, duck


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_kind_of_rule_finds_its_rows(spark):
    rows = [(1, "a", 0.0, 1), (2, None, -0.0, 1), (2, None, None, 3), (None, "b", 2.5, None), (None, "b", float("nan"), 7), (5, "b", float("nan"), 9)]
    df = spark.createDataFrame(rows, "id int, name string, amount double, flag int").repartition(3)
    rules = TableRules("id", not_null=["name", "id"], accepted={"flag": [1, 3], "name": ["a"]}, unique=["amount", "name", "flag"])
    assert found(rule_pass.violations(df, "t", rules)) == sorted(
        [
            ("not_null", "t", "name", "2", None), ("not_null", "t", "name", "2", None),
            ("not_null", "t", "id", None, None), ("not_null", "t", "id", None, None),
            ("accepted_values", "t", "flag", None, "7"), ("accepted_values", "t", "flag", "5", "9"),
            ("accepted_values", "t", "name", None, "b"), ("accepted_values", "t", "name", None, "b"), ("accepted_values", "t", "name", "5", "b"),
            ("unique", "t", "amount", "0.0", "2"), ("unique", "t", "amount", "NaN", "2"),
            ("unique", "t", "name", "b", "3"), ("unique", "t", "flag", "1", "2"),
        ],
        key=str,
    )
    assert found(rule_pass.violations(df.limit(0), "t", rules)) == []


def test_one_scan_a_table_and_no_shuffle_without_unique_rules(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as a", "id % 5 as b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    everything = TableRules("id", not_null=["a", "b"], accepted={"a": [1], "b": [2]}, unique=["id", "a", "b"])
    plan = rule_pass.violations(df, "t", everything)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    rows_only = TableRules("id", not_null=["a", "b"], accepted={"a": [1]})
    plan = rule_pass.violations(df, "t", rows_only)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_report_reads_each_table_once(spark):
    plan = E.queries()["dq_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len({t for t, *_ in quality.NOT_NULL_CHECKS})


def test_report_is_the_three_checks_together(spark):
    full = spark.createDataFrame(
        [(1, None, 5.0, 0), (1, 11, None, 4), (None, 12, 7.0, None)], "order_id long, customer_id long, total_payment double, was_late int"
    )
    checks = (
        [("orders_full", "order_id", "customer_id"), ("orders_full", "customer_id", "total_payment")],
        [("orders_full", "order_id")],
        [("orders_full", "order_id", "was_late", [0, 1])],
    )
    tables = {"orders_full": full}
    apart = [quality.dq_not_null(tables, checks[0]), quality.dq_unique(tables, checks[1]), quality.dq_accepted_values(tables, checks[2])]
    assert found(quality.dq_report(tables, *checks)) == sorted((r for df in apart for r in found(df)), key=str)
    assert len(found(apart[0])) == 2 and found(apart[1])[0][3:] == ("1", "2")


@pytest.mark.parametrize("name", ["dq_report", "dq_seeded"])
def test_queries_against_the_oracle(spark, name):
    r = compare(spark, duck(SF_CHECK), name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"] and r["rows"], r
