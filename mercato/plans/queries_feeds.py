"""Feeds, ordering, top-k, sampling, pivots and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.operators import enrich, feeds, marts
from mercato.plans.oracle import OFULL_OUT, PERIOD, R, RAIN, RAIN_ORDER, TEMP, with_ctes
from mercato.plans.queries_core import ofull, out, src
from mercato.plans.registry import query


def monthly(spark, sf):
    return marts.monthly_revenue(ofull(spark, sf))


def states_tbl(spark, sf):
    return marts.revenue_by_state(ofull(spark, sf))


def named_states(spark, sf):
    return feeds.lookup_state_name(states_tbl(spark, sf), src(spark, sf).states)


NAMED_STATES_SQL = (
    "SELECT e.*, COALESCE(s.state_name, e.customer_state) AS state_name FROM etl_state e "
    "LEFT JOIN src_states s ON e.customer_state = s.state_code"
)


# ------------------------------------------------------------------ §2.6 ordering

def _placed(df, *order):
    """``df`` with its position in the order (bounded: one row per month, state or bucket)."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


@query("sort_monthly", with_ctes("SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY year, month) AS INTEGER) AS position FROM etl_monthly"))
def q_sort_monthly(spark, sf):
    return _placed(feeds.sort_monthly(monthly(spark, sf)), F.monotonically_increasing_id())


@query(
    "sort_states",
    with_ctes("SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY total_revenue DESC, customer_state) AS INTEGER) AS position FROM etl_state"),
)
def q_sort_states(spark, sf):
    return _placed(feeds.sort_states(states_tbl(spark, sf)), F.monotonically_increasing_id())


@query(
    "sort_rain",
    with_ctes(f"SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {RAIN_ORDER('rain_category')}, rain_category) AS INTEGER) AS position FROM mart_weather"),
)
def q_sort_rain(spark, sf):
    from mercato.plans.queries_core import stg

    return _placed(feeds.sort_rain(marts.weather_impact_mart(stg(spark, sf))), F.monotonically_increasing_id())


@query(
    "best_months",
    with_ctes(
        "SELECT year, month, total_orders, total_revenue FROM etl_monthly "
        "ORDER BY total_revenue DESC, year, month LIMIT 5"
    ),
)
def q_best_months(spark, sf):
    return feeds.best_months(monthly(spark, sf), 5)


@query(
    "top_states",
    with_ctes(
        "SELECT customer_state, total_orders, total_revenue FROM etl_state "
        "ORDER BY total_revenue DESC, customer_state LIMIT 5"
    ),
)
def q_top_states(spark, sf):
    return feeds.top_states(states_tbl(spark, sf), 5, ["customer_state", "total_orders", "total_revenue"])


@query(
    "monthly_trend",
    with_ctes("SELECT year, month, total_orders, total_revenue FROM etl_monthly ORDER BY year, month LIMIT 6"),
)
def q_monthly_trend(spark, sf):
    return feeds.monthly_trend(monthly(spark, sf), 6)


@query("head_sample", with_ctes(f"SELECT {OFULL_OUT} FROM ofull ORDER BY order_id LIMIT 5"))
def q_head_sample(spark, sf):
    return out(feeds.head_sample(ofull(spark, sf), 5, "order_id"))


@query(
    "scatter_sample",
    with_ctes(
        "SELECT order_id, temp_max, CAST(total_payment AS DOUBLE) AS total_payment, "
        f"{RAIN('precipitation', 'no_rain')} AS rain_category FROM ofull "
        "WHERE total_payment IS NOT NULL AND temp_max IS NOT NULL AND precipitation IS NOT NULL "
        "ORDER BY md5(CAST(order_id AS VARCHAR) || '-42') LIMIT 2500"
    ),
)
def q_scatter_sample(spark, sf):
    return out(feeds.scatter_sample(ofull(spark, sf), colour="rain_category", n=2500, seed=42))


# ------------------------------------------------------------------ §2.5 / §2.7 shares

_TOP8 = f"""ranked AS (SELECT state_name AS label, total_revenue,
       ROW_NUMBER() OVER (ORDER BY total_revenue DESC, customer_state) AS rn FROM ({NAMED_STATES_SQL}) n),
both_ AS (SELECT label, total_revenue, CAST(rn AS INTEGER) AS slot FROM ranked WHERE rn <= 8
       UNION ALL
       SELECT 'Others', COALESCE(CAST(SUM(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE), 0.0), 9
       FROM ranked WHERE rn > 8)"""


def _with_more(extra_ctes: str, select: str) -> str:
    sql = with_ctes(select)
    head, tail = sql.rsplit("\n", 1)
    return f"{head},\n{extra_ctes}\n{tail}"


@query(
    "state_revenue_share",
    _with_more(
        _TOP8,
        "SELECT label, total_revenue, slot, "
        f"{R('total_revenue * 100.0 / CAST(SUM(CAST(total_revenue AS DECIMAL(38,2))) OVER () AS DOUBLE)', 2)} "
        "AS share_pct FROM both_",
    ),
)
def q_state_revenue_share(spark, sf):
    return feeds.state_revenue_share(named_states(spark, sf), 8)


@query("union_others", _with_more(_TOP8, "SELECT label, total_revenue, slot FROM both_"))
def q_union_others(spark, sf):
    return feeds.state_revenue_share(named_states(spark, sf), 8).drop("share_pct")


# ------------------------------------------------------------------ §2.4 chart aggregates

_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


@query(
    "orders_heatmap",
    with_ctes(
        f"SELECT m.month, {_MONTHS}[m.month] AS month_name, y.year, "
        "CAST(COALESCE((SELECT SUM(e.total_orders) FROM etl_monthly e WHERE e.month = m.month AND e.year = y.year), 0) "
        "AS BIGINT) AS orders FROM (SELECT DISTINCT month FROM etl_monthly WHERE month IS NOT NULL AND year IS NOT NULL) m, "
        "(SELECT DISTINCT year FROM etl_monthly WHERE year IS NOT NULL AND month IS NOT NULL) y"
    ),
)
def q_orders_heatmap(spark, sf):
    return feeds.orders_heatmap(monthly(spark, sf))


@query(
    "delivery_histogram",
    with_ctes(
        "SELECT CAST(FLOOR(delivery_days / 2) * 2 AS INTEGER) AS bin_start, "
        "CAST(FLOOR(delivery_days / 2) * 2 AS INTEGER) + 2 AS bin_end, COUNT(*) AS orders FROM ofull "
        "WHERE total_payment IS NOT NULL AND delivery_days IS NOT NULL AND delivery_days BETWEEN 0 AND 60 "
        "GROUP BY CAST(FLOOR(delivery_days / 2) * 2 AS INTEGER)"
    ),
)
def q_delivery_histogram(spark, sf):
    return feeds.delivery_histogram(ofull(spark, sf), bin_width=2, max_days=60)


_GAUGE_PCT = f"COALESCE({R('CAST(on_time AS DOUBLE) * 100.0 / NULLIF(total, 0)', 1)}, 0.0)"


@query(
    "on_time_gauge",
    with_ctes(
        f"SELECT total, on_time, late, pct AS on_time_pct, {R('pct - 90.0', 1)} AS delta_vs_target, "
        "CASE WHEN pct < 70 THEN '0-70' WHEN pct < 90 THEN '70-90' ELSE '90-100' END AS band "
        f"FROM (SELECT total, on_time, late, {_GAUGE_PCT} AS pct FROM ("
        "SELECT COUNT(*) AS total, CAST(COUNT_IF(was_late = 0) AS BIGINT) AS on_time, "
        "CAST(COUNT_IF(was_late = 1) AS BIGINT) AS late FROM ofull WHERE total_payment IS NOT NULL) g) h"
    ),
)
def q_on_time_gauge(spark, sf):
    """Over the dashboard's order subset (orders with a payment)."""
    return feeds.on_time_gauge(feeds.order_subset(ofull(spark, sf)), target=90.0)


@query("distinct_years", with_ctes("SELECT DISTINCT year FROM etl_monthly WHERE year IS NOT NULL"))
def q_distinct_years(spark, sf):
    return feeds.distinct_years(monthly(spark, sf))


@query(
    "max_payment_bound",
    with_ctes("SELECT CAST(FLOOR(MAX(total_payment)) + 1 AS BIGINT) AS max_payment_bound FROM ofull"),
)
def q_max_payment_bound(spark, sf):
    return feeds.max_payment_bound(ofull(spark, sf))


# ------------------------------------------------------------------ §2.3 lookup, §2.2 search

@query("lookup_state_name", with_ctes(NAMED_STATES_SQL))
def q_lookup_state_name(spark, sf):
    return named_states(spark, sf)


@query(
    "search_states",
    with_ctes(
        f"SELECT * FROM ({NAMED_STATES_SQL}) n WHERE contains(upper(customer_state), 'ION_2') "
        "OR contains(upper(state_name), 'ION_2')"
    ),
)
def q_search_states(spark, sf):
    return feeds.search_states(named_states(spark, sf), "ion_2")


# ------------------------------------------------------------------ §2.9 feeds

@query(
    "feed_trend",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT {PERIOD()} AS period, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM etl_monthly "
            for m in ("total_revenue", "total_orders", "avg_order_value")
        )
    ),
)
def q_feed_trend(spark, sf):
    return feeds.feed_trend(monthly(spark, sf))


@query("feed_monthly_orders", with_ctes(f"SELECT {PERIOD()} AS period, total_orders FROM etl_monthly"))
def q_feed_monthly_orders(spark, sf):
    return feeds.feed_monthly_orders(monthly(spark, sf))


@query("feed_monthly_delivery", with_ctes(f"SELECT {PERIOD()} AS period, avg_delivery_days FROM etl_monthly"))
def q_feed_monthly_delivery(spark, sf):
    return feeds.feed_monthly_delivery(monthly(spark, sf))


@query(
    "feed_state_map",
    with_ctes(
        f"SELECT customer_state AS code, state_name, CAST(total_revenue AS DOUBLE) AS value FROM ({NAMED_STATES_SQL}) n"
    ),
)
def q_feed_state_map(spark, sf):
    return feeds.feed_state_map(states_tbl(spark, sf), src(spark, sf).states, "total_revenue")


@query(
    "feed_state_top10",
    with_ctes("SELECT * FROM etl_state ORDER BY total_revenue DESC, customer_state LIMIT 10"),
)
def q_feed_state_top10(spark, sf):
    return feeds.feed_state_top10(states_tbl(spark, sf))


@query(
    "feed_weather",
    with_ctes(
        f"SELECT {RAIN_ORDER('rain_category', 0, first=0)} AS sort_key, rain_category, total_orders, avg_order_value "
        "FROM etl_weather"
    ),
)
def q_feed_weather(spark, sf):
    return feeds.feed_weather(marts.weather_impact(ofull(spark, sf)))


@query(
    "feed_state_table",
    with_ctes(
        "SELECT customer_state AS code, state_name, total_orders, total_revenue, avg_order_value, "
        f"avg_delivery_days FROM ({NAMED_STATES_SQL}) n WHERE contains(upper(customer_state), 'NATION_1') "
        "OR contains(upper(state_name), 'NATION_1')"
    ),
)
def q_feed_state_table(spark, sf):
    return feeds.feed_state_table(states_tbl(spark, sf), src(spark, sf).states, "nation_1")


# ------------------------------------------------------------------ §2.8 scalar functions

@query(
    "fn_to_date",
    with_ctes("SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS purchase_date FROM src_orders"),
)
def q_fn_to_date(spark, sf):
    o = src(spark, sf).orders
    return o.select("order_id", F.to_date("order_purchase_timestamp").alias("purchase_date"))


@query(
    "fn_to_timestamp",
    with_ctes(
        "SELECT order_id, CAST(strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) "
        "AS purchase_ts FROM src_orders"
    ),
)
def q_fn_to_timestamp(spark, sf):
    o = src(spark, sf).orders
    text = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    return o.select("order_id", F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("purchase_ts"))


@query("fn_datediff", with_ctes("SELECT order_id, delivery_days FROM clean"))
def q_fn_datediff(spark, sf):
    c = enrich.clean_orders(src(spark, sf).orders)
    return c.select("order_id", F.datediff("delivery_date", "purchase_date").alias("delivery_days"))


@query("fn_was_late", with_ctes("SELECT order_id, was_late FROM clean"))
def q_fn_was_late(spark, sf):
    c = enrich.clean_orders(src(spark, sf).orders)
    return c.select("order_id", rules.was_late("delivery_date", "estimated_date").alias("was_late"))


@query("fn_year_month", with_ctes("SELECT order_id, year, month FROM clean"))
def q_fn_year_month(spark, sf):
    c = enrich.clean_orders(src(spark, sf).orders)
    return c.select("order_id", F.year("purchase_date").alias("year"), F.month("purchase_date").alias("month"))


@query(
    "fn_round",
    with_ctes(
        f"SELECT order_id, {R('CAST(total_payment AS DOUBLE) / item_count', 2)} AS avg_item_value_2, "
        f"{R('CAST(total_payment AS DOUBLE) / item_count', 1)} AS avg_item_value_1 FROM ofull"
    ),
)
def q_fn_round(spark, sf):
    d = ofull(spark, sf)
    per_item = F.try_divide(F.col("total_payment").cast("double"), F.col("item_count"))
    return d.select(
        "order_id", F.round(per_item, 2).alias("avg_item_value_2"), F.round(per_item, 1).alias("avg_item_value_1")
    )


@query(
    "fn_cast",
    with_ctes(
        "SELECT order_id, CAST(delivery_days AS DOUBLE) AS delivery_days_d, "
        "CAST(purchase_date AS VARCHAR) AS purchase_date_s, TRY_CAST(customer_state AS DOUBLE) AS state_num, "
        "TRY_CAST(customer_city AS DOUBLE) AS city_num FROM ofull"
    ),
)
def q_fn_cast(spark, sf):
    d = ofull(spark, sf)
    return d.select(
        "order_id",
        F.col("delivery_days").cast("double").alias("delivery_days_d"),
        F.col("purchase_date").cast("string").alias("purchase_date_s"),
        rules.to_number("customer_state").alias("state_num"),
        rules.to_number("customer_city").alias("city_num"),
    )


@query(
    "fn_coalesce",
    with_ctes(
        "SELECT order_id, CAST(COALESCE(total_payment, 0) AS DOUBLE) AS total_payment, "
        "COALESCE(precipitation, 0.0) AS precipitation, COALESCE(delivery_days, 0) AS delivery_days FROM ofull"
    ),
)
def q_fn_coalesce(spark, sf):
    d = ofull(spark, sf)
    return d.select(
        "order_id",
        F.coalesce("total_payment", F.lit(0).cast("decimal(18,2)")).cast("double").alias("total_payment"),
        F.coalesce("precipitation", F.lit(0.0)).alias("precipitation"),
        F.coalesce("delivery_days", F.lit(0)).alias("delivery_days"),
    )


@query(
    "fn_case",
    with_ctes(
        f"SELECT order_id, precipitation, {RAIN('precipitation', 'heavy')} AS rain_null_heavy, "
        f"{RAIN('precipitation', 'no_rain')} AS rain_null_none FROM ofull"
    ),
)
def q_fn_case(spark, sf):
    d = ofull(spark, sf)
    return d.select(
        "order_id", "precipitation",
        rules.rain_category("precipitation", "heavy").alias("rain_null_heavy"),
        rules.rain_category("precipitation", "no_rain").alias("rain_null_none"),
    )


@query("fn_temp_category", with_ctes(f"SELECT order_id, temp_max, {TEMP('temp_max')} AS temp_category FROM ofull"))
def q_fn_temp_category(spark, sf):
    d = ofull(spark, sf)
    return d.select("order_id", "temp_max", rules.temp_category("temp_max").alias("temp_category"))


@query(
    "fn_delivery_status",
    with_ctes(
        "SELECT order_id, was_late, CASE WHEN was_late = 1 THEN 'Late' ELSE 'On Time' END AS delivery_status "
        "FROM ofull"
    ),
)
def q_fn_delivery_status(spark, sf):
    d = ofull(spark, sf)
    return d.select("order_id", "was_late", rules.delivery_status("was_late").alias("delivery_status"))


@query(
    "fn_late_label",
    with_ctes(
        "SELECT order_id, was_late, CASE WHEN was_late = 0 THEN 'On Time' WHEN was_late = 1 THEN 'Late' "
        "ELSE 'Unknown' END AS was_late_str FROM ofull"
    ),
)
def q_fn_late_label(spark, sf):
    d = ofull(spark, sf)
    return d.select("order_id", "was_late", rules.late_label("was_late").alias("was_late_str"))


@query("fn_period", with_ctes(f"SELECT year, month, {PERIOD()} AS period FROM etl_monthly"))
def q_fn_period(spark, sf):
    return monthly(spark, sf).select("year", "month", rules.period("year", "month").alias("period"))


@query(
    "fn_upper_contains",
    with_ctes(
        "SELECT customer_state, state_name, COALESCE(contains(upper(state_name), 'NATION_1'), false) AS matches "
        f"FROM ({NAMED_STATES_SQL}) n"
    ),
)
def q_fn_upper_contains(spark, sf):
    return named_states(spark, sf).select(
        "customer_state", "state_name", rules.upper_contains("state_name", "nation_1").alias("matches")
    )


@query("fn_month_name", with_ctes(f"SELECT year, month, {_MONTHS}[month] AS month_name FROM etl_monthly"))
def q_fn_month_name(spark, sf):
    return monthly(spark, sf).select("year", "month", rules.month_name("month").alias("month_name"))


@query(
    "fn_pct",
    with_ctes(
        "SELECT customer_state, "
        f"{R('CAST(COUNT_IF(precipitation IS NULL) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0)', 1)} "
        "AS null_weather_pct FROM ofull GROUP BY customer_state"
    ),
)
def q_fn_pct(spark, sf):
    d = ofull(spark, sf)
    return d.groupBy("customer_state").agg(
        rules.pct(F.count_if(F.col("precipitation").isNull()), F.count(F.lit(1)), 1).alias("null_weather_pct")
    )
