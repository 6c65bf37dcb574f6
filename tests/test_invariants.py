"""Cross-table invariants at sf0.01 (SURVEY §5 (c))."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_CHECK


def _total(df, col="total_orders"):
    return df.agg(F.sum(col)).collect()[0][0]


def test_order_totals_agree_across_tables(spark):
    q = E.queries()
    n = q["orders_full"](spark, SF_CHECK).count()
    assert _total(q["monthly_revenue"](spark, SF_CHECK)) == n
    assert _total(q["revenue_by_state"](spark, SF_CHECK)) == n
    assert _total(q["weather_impact"](spark, SF_CHECK)) == n
    assert _total(q["weather_impact_weighted"](spark, SF_CHECK)) == n
    assert _total(q["quarter_seasonality"](spark, SF_CHECK)) == n
    # staged marts: only orders with a positive payment
    stg = q["stg_orders"](spark, SF_CHECK).count()
    assert _total(q["monthly_revenue_mart"](spark, SF_CHECK)) == stg
    assert _total(q["weather_impact_mart"](spark, SF_CHECK)) == stg


def test_left_joins_preserve_delivered_orders(spark):
    q = E.queries()
    delivered = q["filter_delivered"](spark, SF_CHECK).count()
    for name in ("clean_orders", "join_customers", "join_payments", "join_items", "join_weather", "orders_full"):
        assert q[name](spark, SF_CHECK).count() == delivered, name


def test_revenue_totals_agree(spark):
    q = E.queries()
    kpi = q["kpi_summary"](spark, SF_CHECK).collect()[0]
    months = q["monthly_revenue"](spark, SF_CHECK).agg(F.sum(F.col("total_revenue").cast("decimal(38,2)"))).collect()[0][0]
    assert float(months) == kpi.total_revenue
