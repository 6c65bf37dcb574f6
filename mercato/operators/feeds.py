"""Chart-ready feeds, top-k lists, shares, pivots, histograms and samples.

Rendering is out of scope; every feed is a DataFrame a chart can plot.
Top-k uses ``orderBy(...).limit(k)`` (each task keeps its own k rows, then
one merge of k x tasks rows). Samples are bottom-k by a hash of the key:
reproducible under any partitioning and checkable against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.functions.money import cents, from_cents, money_sum

ORDER_SUBSET_COLUMNS = [
    "order_id", "purchase_date", "total_payment", "delivery_days", "was_late",
    "customer_state", "temp_max", "precipitation", "year", "month",
]


def order_subset(orders_full: DataFrame) -> DataFrame:
    """The 10 columns the dashboards read, orders with a payment only."""
    return orders_full.where(F.col("total_payment").isNotNull()).select(*ORDER_SUBSET_COLUMNS)


def filter_years(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """year IN (...); None selects every year, an empty selection no rows."""
    if years is None:
        return df
    years = list(years)
    if not years:
        return df.where(F.lit(False))
    return df.where(F.col("year").isin(years))


# ------------------------------------------------------------------ states


def state_dimension(spark: SparkSession) -> DataFrame:
    """The fixed Brazilian code -> name lookup as a small DataFrame."""
    return spark.createDataFrame(sorted(rules.BR_STATES.items()), "state_code string, state_name string")


def lookup_state_name(df: DataFrame, states: DataFrame, code_col: str = "customer_state") -> DataFrame:
    """Add ``state_name`` (defaulting to the code) by a left join to the state
    dimension. The dimension is one row per state; the planner broadcasts it
    from its size statistic."""
    dim = states.select(F.col("state_code").alias("_code"), F.col("state_name").alias("_name"))
    return (
        df.join(dim, df[code_col] == dim["_code"], "left")
        .withColumn("state_name", F.coalesce(F.col("_name"), F.col(code_col)))
        .drop("_code", "_name")
    )


def search_states(state_table: DataFrame, search: str | None, regex: bool = False) -> DataFrame:
    """Case-insensitive match on code OR name; empty search keeps all."""
    if not search:
        return state_table
    return state_table.where(
        rules.upper_contains("customer_state", search, regex) | rules.upper_contains("state_name", search, regex)
    )


def state_revenue_share(state_table: DataFrame, top: int = 8, label_col: str = "state_name") -> DataFrame:
    """Top ``top`` states by revenue plus one 'Others' row (always present,
    0 when there are no more states), with each row's % of the total.

    One pass over the per-state table (one row per state): states beyond the
    top share one slot, and a literal row stands for an absent 'Others'."""
    w = Window.orderBy(F.desc("total_revenue"), F.col("customer_state"))  # bounded: one row per state
    rn = F.row_number().over(w)
    ranked = state_table.select(F.col(label_col).alias("label"), "total_revenue", rn.alias("_rn"))
    slots = ranked.select(
        F.when(F.col("_rn") <= top, F.col("label")).otherwise(rules.OTHERS).alias("label"),
        "total_revenue",
        F.least("_rn", F.lit(top + 1)).alias("slot"),
    )
    none = slots.sparkSession.range(1).select(
        F.lit(rules.OTHERS).alias("label"), F.lit(0.0).alias("total_revenue"), F.lit(top + 1).alias("slot")
    )
    both = slots.unionByName(none).groupBy("label", "slot").agg(money_sum("total_revenue").alias("total_revenue"))
    return (
        both.withColumn("_total", from_cents(F.sum(cents("total_revenue")).over(Window.partitionBy())))
        .select(
            "label", "total_revenue", "slot",
            F.round(F.try_divide(F.col("total_revenue") * F.lit(100.0), F.col("_total")), 2).alias("share_pct"),
        )
        .orderBy("slot")
    )


# ------------------------------------------------------------------ ordering


def sort_monthly(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("year", "month")


def sort_states(state_table: DataFrame) -> DataFrame:
    return state_table.orderBy(F.desc("total_revenue"), "customer_state")


def sort_rain(weather_table: DataFrame, unknown: int = 4) -> DataFrame:
    """No / Light / Heavy rain order; unknown labels last (``unknown=4``) or
    first (``unknown=0``, as the dashboard does)."""
    return weather_table.orderBy(rules.rain_order("rain_category", unknown), "rain_category")


def best_months(monthly: DataFrame, k: int = 5) -> DataFrame:
    return monthly.select("year", "month", "total_orders", "total_revenue").orderBy(
        F.desc("total_revenue"), "year", "month"
    ).limit(k)


def top_states(state_table: DataFrame, k: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns) if columns else state_table.columns
    return state_table.orderBy(F.desc("total_revenue"), "customer_state").limit(k).select(*cols)


def monthly_trend(monthly: DataFrame, k: int = 6) -> DataFrame:
    """The *first* k months in calendar order."""
    return monthly.select("year", "month", "total_orders", "total_revenue").orderBy("year", "month").limit(k)


def head_sample(df: DataFrame, n: int = 5, key: str | Sequence[str] = "order_id") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def _paid(pay_range: tuple[float, float] | None):
    """Orders with a payment, within the range where one is chosen."""
    paid = F.col("total_payment").isNotNull()
    return paid if pay_range is None else paid & F.col("total_payment").between(*pay_range)


SCATTER_COLOURS = ("rain_category", "was_late_str", "customer_state")


def scatter_sample(
    orders: DataFrame,
    years: Sequence[int] | None = None,
    pay_range: tuple[float, float] | None = None,
    colour: str = "rain_category",
    n: int = 2500,
    seed: int = 42,
) -> DataFrame:
    """At most ``n`` orders in the selection with weather present: bottom-n by
    md5(order_id || '-' || seed). Columns: order_id, temp_max, total_payment,
    and the colour column. The payment range excludes orders without a
    payment, as the dashboard's order subset does."""
    if colour not in SCATTER_COLOURS:
        raise ValueError(f"colour must be one of {SCATTER_COLOURS}")
    df = filter_years(orders, years).where(
        _paid(pay_range) & F.col("temp_max").isNotNull() & F.col("precipitation").isNotNull()
    )
    colour_expr = {
        "rain_category": rules.rain_category("precipitation", null_policy="no_rain"),
        "was_late_str": rules.late_label("was_late"),
        "customer_state": F.col("customer_state"),
    }[colour]
    key = F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f"-{seed}")))
    return (
        df.select("order_id", "temp_max", "total_payment", colour_expr.alias(colour), key.alias("_k"))
        .orderBy("_k")
        .limit(n)
        .drop("_k")
    )


# ------------------------------------------------------------------ charts


def orders_heatmap(monthly: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Cells (month, month_name, year, orders) of the month x year grid, 0
    where a month has no row: every month of the table by every year of it (or
    the chosen years), found from the data. Runs on the monthly table."""
    rows = filter_years(monthly, years).where(F.col("year").isNotNull() & F.col("month").isNotNull())
    every = F.collect_set("year").over(Window.partitionBy())  # bounded: one row per month
    grid = rows.withColumn("_years", every).select("month", F.explode("_years").alias("year")).distinct()
    cells = rows.groupBy("month", "year").agg(F.sum("total_orders").alias("orders"))
    return (
        grid.join(cells, ["month", "year"], "left")
        .select("month", rules.month_name("month").alias("month_name"), "year", F.coalesce("orders", F.lit(0)).alias("orders"))
        .orderBy("month", "year")
    )


def delivery_histogram(
    orders: DataFrame,
    years: Sequence[int] | None = None,
    pay_range: tuple[float, float] | None = None,
    bin_width: int = 2,
    max_days: int = 60,
) -> DataFrame:
    """Orders per delivery-days bin (0..max_days, width ``bin_width``)."""
    d = F.col("delivery_days")
    df = filter_years(orders, years).where(
        _paid(pay_range) & d.isNotNull() & d.between(0, max_days)
    )
    b = (F.floor(d / bin_width) * bin_width).cast("int")
    return (
        df.groupBy(b.alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("bin_end", F.col("bin_start") + bin_width)
        .select("bin_start", "bin_end", "orders")
        .orderBy("bin_start")
    )


def on_time_gauge(orders: DataFrame, years: Sequence[int] | None = None, target: float = 90.0) -> DataFrame:
    """total / on-time / late counts, on-time % (0 when empty), delta vs the
    target and the gauge band (0-70, 70-90, 90-100). ``orders`` is the
    dashboard's order subset (:func:`order_subset`: orders with a payment)."""
    df = filter_years(orders, years)
    g = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("was_late") == 0).alias("on_time"),
        F.count_if(F.col("was_late") == 1).alias("late"),
    )
    pct = F.coalesce(F.round(F.try_divide(F.col("on_time") * F.lit(100.0), F.col("total")), 1), F.lit(0.0))
    return g.withColumn("on_time_pct", pct).withColumns({
        "delta_vs_target": F.round(F.col("on_time_pct") - F.lit(float(target)), 1),
        "band": F.when(F.col("on_time_pct") < 70, "0-70").when(F.col("on_time_pct") < 90, "70-90").otherwise("90-100"),
    })


def distinct_years(monthly: DataFrame) -> DataFrame:
    return monthly.where(F.col("year").isNotNull()).select("year").distinct().orderBy("year")


def max_payment_bound(orders: DataFrame) -> DataFrame:
    """int(max(total_payment)) + 1, the slider's upper bound."""
    return orders.agg((F.floor(F.max("total_payment")) + 1).cast("long").alias("max_payment_bound"))


# ------------------------------------------------------------------ feeds

TREND_METRICS = ("total_revenue", "total_orders", "avg_order_value")


def feed_trend(monthly: DataFrame, years: Sequence[int] | None = None, metric: str | None = None) -> DataFrame:
    """(period, metric, value) for the selected (default: all) years; all three metrics
    unless one is chosen."""
    metrics = [metric] if metric else list(TREND_METRICS)
    for m in metrics:
        if m not in TREND_METRICS:
            raise ValueError(f"metric must be one of {TREND_METRICS}")
    df = filter_years(monthly, years).select(
        rules.period("year", "month").alias("period"), *[F.col(m).cast("double").alias(m) for m in metrics]
    )
    return df.unpivot("period", metrics, "metric", "value")


def feed_monthly_orders(monthly: DataFrame) -> DataFrame:
    return monthly.select(rules.period("year", "month").alias("period"), "total_orders")


def feed_monthly_delivery(monthly: DataFrame) -> DataFrame:
    return monthly.select(rules.period("year", "month").alias("period"), "avg_delivery_days")


MAP_METRICS = ("total_revenue", "total_orders", "avg_delivery_days")


def feed_state_map(state_table: DataFrame, states: DataFrame, metric: str = "total_revenue") -> DataFrame:
    if metric not in MAP_METRICS:
        raise ValueError(f"metric must be one of {MAP_METRICS}")
    return lookup_state_name(state_table, states).select(
        F.col("customer_state").alias("code"), "state_name", F.col(metric).cast("double").alias("value")
    )


def feed_state_top10(state_table: DataFrame) -> DataFrame:
    return top_states(state_table, 10)


def feed_weather(weather_table: DataFrame) -> DataFrame:
    """3 rows in rain order with the dashboard's key: No / Light / Heavy rain =
    0 / 1 / 2, unknown labels 0."""
    return weather_table.select(
        rules.rain_order("rain_category", unknown=0, first=0).alias("sort_key"),
        "rain_category", "total_orders", "avg_order_value",
    ).orderBy("sort_key", "rain_category")


def feed_state_table(state_table: DataFrame, states: DataFrame, search: str | None = None) -> DataFrame:
    named = lookup_state_name(state_table, states)
    return search_states(named, search).select(
        F.col("customer_state").alias("code"), "state_name", "total_orders", "total_revenue",
        "avg_order_value", "avg_delivery_days",
    ).orderBy(F.desc("total_revenue"), "code")
