"""The run report: one nested row {pipeline_run_time, key_metrics,
top_states[k], monthly_trend[k]} written as JSON.

Arrays are built from already-aggregated tables (one row per state / month)
and cut to k entries before collecting, so no array grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators import marts


def _ranked_array(df: DataFrame, order, fields, k: int, name: str) -> DataFrame:
    w = Window.orderBy(*order)  # one row per state / month: bounded
    top = df.select(F.row_number().over(w).alias("_pos"), *fields).where(F.col("_pos") <= k)
    arr = F.sort_array(F.collect_list(F.struct("_pos", *fields)))
    return top.agg(arr.alias("_a")).select(
        F.lit(1).alias("_k"),
        F.transform("_a", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name),
    )


def build_report(
    orders_full: DataFrame,
    state_table: DataFrame,
    monthly_table: DataFrame,
    run_time: str,
    top_k: int = 5,
    trend_k: int = 6,
) -> DataFrame:
    """One row. ``run_time`` is passed in so runs are reproducible."""
    kpis = marts.kpi_summary_rate(orders_full).select(F.lit(1).alias("_k"), F.struct("*").alias("key_metrics"))
    top = _ranked_array(
        state_table, [F.desc("total_revenue"), F.col("customer_state")],
        ["customer_state", "total_orders", "total_revenue"], top_k, "top_states",
    )
    trend = _ranked_array(
        monthly_table, [F.col("year"), F.col("month")],
        ["year", "month", "total_orders", "total_revenue"], trend_k, "monthly_trend",
    )
    return (
        kpis.join(top, "_k").join(trend, "_k")
        .select(F.lit(run_time).alias("pipeline_run_time"), "key_metrics", "top_states", "monthly_trend")
    )


def write_report_json(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
