"""The end-to-end batch: transform -> load -> validate -> report.

One call runs what the reference runs stage by stage: build ``orders_full``
from the raw tables and store it partitioned by year/month; build the three
summary tables and the staged marts from the stored table and register them
in a catalog database; run the data-quality checks (raising on failure, as
the reference's validation stage does); write the nested JSON report.
Scheduling is out of scope (run it from any scheduler).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from mercato.operators import enrich, marts, quality, report
from mercato.sources import io, versions
from mercato.sources.fixtures import Sources


@dataclass
class BatchResult:
    out_dir: str
    database: str
    rows_written: dict[str, int] = field(default_factory=dict)
    checks: dict[str, int] = field(default_factory=dict)
    report_path: str = ""


def _checks(tables: dict) -> dict:
    s = tables
    return {
        "row_counts": quality.dq_row_counts(
            {k: s[k] for k in ("orders_full", "monthly_revenue", "revenue_by_state", "weather_impact")}
        ),
        "null_counts": quality.dq_null_counts(s["orders_full"]),
        "not_null": quality.dq_not_null(_dq_view(s)),
        "unique": quality.dq_unique(_dq_view(s)),
        "accepted_values": quality.dq_accepted_values(_dq_view(s)),
        "positive_revenue": quality.dq_positive_revenue(s["monthly_revenue_mart"]),
        "late_rate_range": quality.dq_late_rate_range(s["revenue_by_state_mart"]),
    }


def _dq_view(s: dict) -> dict:
    return {
        "orders_full": s["orders_full"],
        "stg_orders": s["stg_orders"],
        "stg_weather": s["stg_weather"],
        "monthly_revenue": s["monthly_revenue_mart"],
        "revenue_by_state": s["revenue_by_state_mart"],
        "weather_impact": s["weather_impact_mart"],
    }


# The staging views as SQL, so that they outlive the session; tests hold them
# against enrich.stg_orders and enrich.stg_weather.
STAGING_VIEWS = {
    "stg_orders": """
SELECT order_id, customer_id, customer_state, customer_city,
       order_purchase_timestamp AS purchase_ts, order_delivered_customer_date AS delivered_ts,
       order_estimated_delivery_date AS estimated_ts, purchase_date, delivery_date, estimated_date,
       total_payment, coalesce(delivery_days, 0) AS delivery_days, coalesce(item_count, 0L) AS item_count,
       coalesce(items_total, 0.0D) AS items_total, coalesce(freight_total, 0.0D) AS freight_total, was_late,
       CASE WHEN was_late = 1 THEN 'Late' ELSE 'On Time' END AS delivery_status, year, month, temp_max,
       coalesce(precipitation, 0.0D) AS precipitation, rain_category
FROM {table} WHERE order_id IS NOT NULL AND total_payment > 0""",
    "stg_weather": """
SELECT DISTINCT purchase_date AS weather_date, temp_max, precipitation, rain_category,
       CASE WHEN temp_max >= 30 THEN 'Hot' WHEN temp_max >= 22 THEN 'Warm' ELSE 'Cool' END AS temp_category
FROM {table} WHERE purchase_date IS NOT NULL""",
}


def run_batch(
    spark: SparkSession,
    src: Sources,
    out_dir: str,
    run_time: str,
    database: str = "analytics",
    top_state: str | None = None,
    raise_on_failure: bool = True,
) -> BatchResult:
    """Run every stage; tables land under ``out_dir`` (a shared folder)."""
    out_dir = out_dir.rstrip("/")
    res = BatchResult(out_dir=out_dir, database=database)

    # transform: the enriched fact table, stored once; a lookup that would double
    # orders fails the run with its keys before readers see anything of it
    guards = enrich.OrderGuards()
    full = enrich.orders_full_from(src, guards)
    io.ensure_database(spark, database, f"{out_dir}/{database}.db")
    res.rows_written["orders_full"] = versions.replace_table(
        full, f"{database}.orders_full", f"{out_dir}/orders_full", ["year", "month"], guards.check
    )
    stored = spark.table(f"{database}.orders_full")

    # load: summary tables and staged marts, all derived from the stored table
    stg = enrich.stg_orders(stored)
    tables = {
        "orders_full": stored,
        "monthly_revenue": marts.monthly_revenue(stored),
        "revenue_by_state": marts.revenue_by_state(stored),
        "weather_impact": marts.weather_impact(stored),
        "stg_orders": stg,
        "stg_weather": enrich.stg_weather(stored),
        "monthly_revenue_mart": marts.monthly_revenue_mart(stg),
        "revenue_by_state_mart": marts.revenue_by_state_mart(stg),
        "weather_impact_mart": marts.weather_impact_mart(stg),
    }
    for name in ("monthly_revenue", "revenue_by_state", "weather_impact",
                 "monthly_revenue_mart", "revenue_by_state_mart", "weather_impact_mart"):
        res.rows_written[name] = versions.replace_table(tables[name], f"{database}.{name}", f"{out_dir}/{database}.db/{name}")
        tables[name] = spark.table(f"{database}.{name}")
    for view, sql in STAGING_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{view} AS {sql.format(table=f'`{database}`.orders_full')}")

    # validate
    checks = _checks(tables)
    if top_state is not None:
        checks["top_state"] = quality.dq_top_state(tables["revenue_by_state_mart"], top_state)
    res.checks = quality.run_checks(checks, raise_on_failure=False)
    failures = res.checks.failures

    # report (written even when checks fail, so the failure can be inspected)
    res.report_path = f"{out_dir}/pipeline_report"
    report.write_report_json(
        report.build_report(stored, tables["revenue_by_state"], tables["monthly_revenue"], run_time),
        res.report_path,
    )
    if failures and raise_on_failure:
        raise quality.DataQualityError(failures)
    return res
