"""Aggregated tables: the ETL summaries, the staged marts and KPIs.

All group-bys aggregate partially before the shuffle, so a hot key (a state
holding a third of the orders) costs one partial row per task. Medians use
:func:`mercato.functions.median.exact_median`, which never merges a whole
group in one task. Windows without a partition (rank, growth) run only on
already-aggregated rows (one per month or per state).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.functions.median import exact_median
from mercato.functions.money import avg_exact, money_avg, money_sum, present
from mercato.plans.joins import join_on_keys


def _summary_aggs(days_scale: int = 1, with_late: bool = True):
    aggs = [
        F.count("order_id").alias("total_orders"),
        F.round(money_sum("total_payment"), 2).alias("total_revenue"),
        F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
        F.round(avg_exact("delivery_days"), days_scale).alias("avg_delivery_days"),
    ]
    if with_late:
        aggs.append(F.sum("was_late").alias("late_deliveries"))
    return aggs


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


# --------------------------------------------------------------------------- ETL


def monthly_revenue(orders_full: DataFrame, days_scale: int = 1, drop_null_keys: bool = False) -> DataFrame:
    """(year, month): orders, revenue, avg value, avg delivery days, late count.

    ``days_scale=2, drop_null_keys=True`` gives the single-machine fallback's
    variant (every value to 2 decimals, NULL keys dropped).
    """
    df = _drop_null_keys(orders_full, ["year", "month"]) if drop_null_keys else orders_full
    return df.groupBy("year", "month").agg(*_summary_aggs(days_scale)).orderBy("year", "month")


def revenue_by_state(orders_full: DataFrame, days_scale: int = 1, drop_null_keys: bool = False) -> DataFrame:
    df = _drop_null_keys(orders_full, ["customer_state"]) if drop_null_keys else orders_full
    return (
        df.groupBy("customer_state")
        .agg(*_summary_aggs(days_scale, with_late=False))
        .orderBy(F.desc("total_revenue"), "customer_state")
    )


def weather_impact(orders_full: DataFrame) -> DataFrame:
    """Two-level: per precipitation value (avg rounded to 2), then per rain
    bucket: summed orders and the *unweighted* mean of those averages.
    NULL precipitation falls into 'Heavy Rain'."""
    per_value = orders_full.groupBy("precipitation").agg(
        F.count("order_id").alias("total_orders"),
        F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
    )
    return (
        per_value.withColumn("rain_category", rules.rain_category("precipitation", null_policy="heavy"))
        .groupBy("rain_category")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.round(money_avg("avg_order_value"), 2).alias("avg_order_value"),
        )
    )


def weather_impact_weighted(orders_full: DataFrame) -> DataFrame:
    """Row-weighted: bucket each order (missing precipitation = no rain)."""
    return (
        orders_full.withColumn("rain_category", rules.rain_category("precipitation", null_policy="no_rain"))
        .groupBy("rain_category")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
        )
    )


# ------------------------------------------------------------------------ marts


def _median_by(stg: DataFrame, keys: Sequence[str], approx: bool) -> DataFrame:
    if approx:
        return stg.groupBy(*keys).agg(
            F.percentile_approx(present("total_payment"), 0.5, 10000).alias("_median")
        )
    return exact_median(stg, keys, "total_payment", out="_median", width=655.36)


def _mart_aggs():
    return [
        F.count("order_id").alias("total_orders"),
        F.round(money_sum("total_payment"), 2).alias("total_revenue"),
        F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
        F.round(avg_exact("delivery_days"), 1).alias("avg_delivery_days"),
        F.sum("was_late").alias("late_deliveries"),
        F.round(
            F.try_divide(F.sum("was_late").cast("double") * F.lit(100.0), F.count("order_id")), 2
        ).alias("late_rate_pct"),
    ]


def monthly_revenue_mart(stg: DataFrame, approx_median: bool = False, with_median: bool = True) -> DataFrame:
    """Monthly mart over staged orders: + period, median, late rate, items.

    ``with_median=False`` leaves out ``median_order_value`` for consumers that
    do not read it (checks on the other columns): the median's join keys may
    be NULL, so the optimizer cannot drop that branch by itself."""
    keys = ["year", "month"]
    agg = stg.groupBy(*keys).agg(
        *_mart_aggs(), F.round(avg_exact("item_count"), 1).alias("avg_items_per_order")
    )
    if with_median:
        med = _median_by(stg, keys, approx_median)
        agg = join_on_keys(agg, med, keys)
    return (
        agg.select(
            "year", "month",
            rules.period("year", "month").alias("period"),
            "total_orders", "total_revenue", "avg_order_value",
            *([F.round("_median", 2).alias("median_order_value")] if with_median else []),
            "avg_delivery_days", "late_deliveries", "late_rate_pct", "avg_items_per_order",
        )
        .orderBy("year", "month")
    )


def revenue_by_state_mart(stg: DataFrame, approx_median: bool = False, with_median: bool = True) -> DataFrame:
    """State mart: + median, late rate, and RANK by the unrounded revenue;
    ``with_median=False`` leaves the median out for consumers of the rest."""
    keys = ["customer_state"]
    s = stg.where(F.col("customer_state").isNotNull())
    agg = s.groupBy(*keys).agg(*_mart_aggs(), money_sum("total_payment").alias("_revenue"))
    if with_median:
        agg = join_on_keys(agg, _median_by(s, keys, approx_median), keys, null_safe=False)  # NULL states filtered above
    rank_w = Window.orderBy(F.desc("_revenue"))  # one row per state: bounded
    return (
        agg.select(
            "customer_state", "total_orders", "total_revenue", "avg_order_value",
            *([F.round("_median", 2).alias("median_order_value")] if with_median else []),
            "avg_delivery_days", "late_deliveries", "late_rate_pct",
            F.rank().over(rank_w).alias("revenue_rank"),
        )
        .orderBy(F.desc("total_revenue"), "customer_state")
    )


def weather_impact_mart(stg: DataFrame) -> DataFrame:
    return (
        stg.where(F.col("rain_category").isNotNull())
        .groupBy("rain_category")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
            F.round(money_sum("total_payment"), 2).alias("total_revenue"),
            F.round(money_avg("precipitation"), 2).alias("avg_precipitation_mm"),
            F.round(money_avg("temp_max"), 1).alias("avg_temp_max_c"),
        )
        .orderBy(rules.rain_order("rain_category"))
    )


# ------------------------------------------------------------------------- KPIs


def kpi_summary(orders_full: DataFrame) -> DataFrame:
    """Global KPIs (always one row, even over no input)."""
    return orders_full.agg(
        F.count("order_id").alias("total_orders"),
        F.round(money_sum("total_payment"), 2).alias("total_revenue"),
        F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
        F.round(avg_exact("delivery_days"), 1).alias("avg_delivery_days"),
        F.sum("was_late").alias("total_late_deliveries"),
    )


def kpi_summary_rate(orders_full: DataFrame) -> DataFrame:
    """KPIs + late_delivery_rate_pct (NULL instead of a division error when empty)."""
    return orders_full.agg(
        F.count("order_id").alias("total_orders"),
        F.round(money_sum("total_payment"), 2).alias("total_revenue"),
        F.round(money_avg("total_payment"), 2).alias("avg_order_value"),
        F.round(avg_exact("delivery_days"), 1).alias("avg_delivery_days"),
        F.sum("was_late").alias("total_late_deliveries"),
        F.round(
            F.try_divide(F.sum("was_late").cast("double") * F.lit(100.0), F.count("order_id")), 2
        ).alias("late_delivery_rate_pct"),
    )


def late_rate_by_state(state_mart: DataFrame) -> DataFrame:
    """States ordered by worst late rate."""
    return state_mart.select(
        "customer_state", "total_orders", "late_deliveries", "late_rate_pct"
    ).orderBy(F.desc("late_rate_pct"), "customer_state")


def mom_revenue_growth(monthly: DataFrame) -> DataFrame:
    """Month-over-month % change of revenue (window over the monthly rows)."""
    w = Window.orderBy("year", "month")  # one row per month: bounded
    prev = F.lag("total_revenue").over(w)
    return monthly.select(
        "year", "month", "total_revenue",
        prev.alias("prev_revenue"),
        F.round(F.try_divide((F.col("total_revenue") - prev) * F.lit(100.0), prev), 2).alias("growth_pct"),
    )


def quarter_seasonality(orders_full: DataFrame) -> DataFrame:
    return (
        orders_full.groupBy("year", F.quarter("purchase_date").alias("quarter"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(money_sum("total_payment"), 2).alias("total_revenue"),
        )
        .orderBy("year", "quarter")
    )
