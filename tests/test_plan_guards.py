"""Plan guards for every registered query: no cross joins, no nested-loop
joins, no Python UDF operators; column and partition pruning where the
stored table is read."""

from __future__ import annotations

import re

import pytest

from conftest import SF_SMALL
from mercato.plans.registry import QUERIES, load_all

FORBIDDEN = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF",
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    load_all()
    qs = QUERIES
    return {name: _plan(fn(spark, SF_SMALL)) for name, fn in sorted(qs.items())}


def test_no_forbidden_operators(plans):
    bad = {n: [op for op in FORBIDDEN if op in p] for n, p in plans.items()}
    assert {n: ops for n, ops in bad.items() if ops} == {}


def test_marts_read_only_needed_columns(plans):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plans["monthly_revenue"])
    cols = {c.split(":")[0] for s in scans for c in s.split(",")}
    assert cols == {"order_id", "total_payment", "delivery_days", "was_late"}


def test_year_filter_prunes_partitions(plans):
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*IN \(1997,1998\)", plans["filter_year_in"])


def test_raw_scans_push_filters_and_prune(spark, plans):
    from mercato.sources import fixtures

    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in _plan(fixtures.weather(spark, SF_SMALL))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plans["payments_agg"])
    cols = {c.split(":")[0] for s in scans for c in s.split(",")}
    assert cols == {"l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"}
