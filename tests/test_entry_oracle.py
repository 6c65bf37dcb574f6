"""Driver contract and a representative oracle comparison at sf0.01.

The full comparison of every registered query runs with
``python tests/oracle_check.py``.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK
from mercato.plans.registry import ORACLE, QUERIES, load_all
from oracle_check import compare, duck

REPRESENTATIVE = [
    "orders_full", "monthly_revenue", "revenue_by_state", "weather_impact",
    "monthly_revenue_mart", "revenue_by_state_mart", "weather_impact_mart", "kpi_summary_rate",
    "state_revenue_share", "scatter_sample", "orders_heatmap", "table_profile", "dq_not_null",
    "cross_file_totals", "sink_parquet", "scan_weather_json",
]


def registered():
    """The library's own queries (those of optional packages have their own tests)."""
    load_all()
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    return QUERIES, ORACLE


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 1
    assert df.columns[:3] == ["year", "month", "period"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, orc = registered()
    assert len(qs) >= 100
    assert set(qs) - set(orc) == {"sink_report_json", "table_catalog"}
    assert "union_table_totals" in orc


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", REPRESENTATIVE)
def test_against_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["ok"], r.get("note")


def test_output_columns_are_named(spark):
    """Every output column is aliased (no generated names like sum(x)) and
    unique, so Spark and SQL results line up by name."""
    from conftest import SF_SMALL

    skip = {"sink_table", "table_mart", "table_catalog", "scan_csv", "scan_csv_dates", "csv_to_parquet",
            "sink_csv", "scan_parquet", "sink_parquet", "scan_weather_json", "sink_report_json"}
    for name, fn in registered()[0].items():
        if name in skip:
            continue
        cols = fn(spark, SF_SMALL).columns
        assert len(cols) == len(set(cols)), name
        assert not any("(" in c or " " in c for c in cols), (name, cols)
