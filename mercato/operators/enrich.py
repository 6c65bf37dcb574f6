"""Clean + enrich: one row per delivered order (``orders_full``).

Join plan (all left outer, left row count preserved):

    delivered orders ⟕ payments_agg     on order_id   (pre-aggregated: 1 : ≤1)
                     ⟕ items_agg        on order_id   (pre-aggregated: 1 : ≤1)
                     ⟕ customers        on customer_id
                     ⟕ weather          on purchase_date = date

Payments and items are aggregated to order grain *before* the join, so the
join never fans out and each shuffle carries one row per order. Both
aggregates come out hash-partitioned on order_id, and the two order_id joins
run first, so they share one partitioning of the orders (no re-shuffle
between them). Customers are joined next: broadcast when the planner's size
statistic is under the threshold, otherwise a shuffle join whose skewed
customer_id partitions AQE splits. Weather is one row per calendar day: its
stored table is broadcast when its file size is under the planner's threshold
and shuffle-joined otherwise. Building the plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.functions.money import money_sum
from mercato.operators.lookups import JoinAudit, JoinGuard, lookup_join
from mercato.sources.schemas import MONEY


def filter_delivered(orders: DataFrame) -> DataFrame:
    """order_status == 'delivered' (NULL status is dropped)."""
    return orders.where(F.col("order_status") == rules.DELIVERED)


def with_order_dates(orders: DataFrame) -> DataFrame:
    """Derived date columns of a cleaned order (see SURVEY §2.8)."""
    return orders.withColumns({
        "purchase_date": F.to_date("order_purchase_timestamp"),
        "delivery_date": F.to_date("order_delivered_customer_date"),
        "estimated_date": F.to_date("order_estimated_delivery_date"),
    }).withColumns({
        "delivery_days": F.datediff("delivery_date", "purchase_date"),
        "was_late": rules.was_late("delivery_date", "estimated_date"),
        "year": F.year("purchase_date"),
        "month": F.month("purchase_date"),
    })


def clean_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with purchase/delivery/estimated dates, delivery_days,
    was_late, year and month."""
    return with_order_dates(filter_delivered(orders))


def project_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_state", "customer_city")


def payments_agg(payments: DataFrame) -> DataFrame:
    """Per order: exact total_payment and payment_count (partial + final agg)."""
    return payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("total_payment"),
        F.count("payment_sequential").alias("payment_count"),
    )


def items_agg(order_items: DataFrame) -> DataFrame:
    """Per order: item_count, items_total, freight_total."""
    return order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        money_sum("price").alias("items_total"),
        money_sum("freight_value").alias("freight_total"),
    )


def join_customers(
    orders: DataFrame, customers: DataFrame, guard: JoinGuard | None = None, hot: dict | None = None
) -> DataFrame:
    """State and city of each order's customer. With ``guard`` the rows are
    counted in the job that runs the join, with ``hot`` (customer: share) the
    rows of such customers are spread over tasks (see operators/lookups.py)."""
    if guard is None and not hot:
        return orders.join(project_customers(customers), on="customer_id", how="left")
    return lookup_join(orders, project_customers(customers), "customer_id", guard, hot)


def join_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orders.join(payments_agg(payments), on="order_id", how="left")


def join_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    return orders.join(items_agg(order_items), on="order_id", how="left")


def clean_weather(weather: DataFrame) -> DataFrame:
    return weather.select(
        F.to_date("date").alias("date"),
        F.col("temp_max").cast("double").alias("temp_max"),
        F.col("precipitation").cast("double").alias("precipitation"),
    )


def join_weather(orders: DataFrame, weather: DataFrame, guard: JoinGuard | None = None) -> DataFrame:
    """Left join on purchase_date = date; the weather key column is dropped.
    The planner broadcasts a stored weather table by its file size."""
    w = clean_weather(weather)
    if guard is not None:
        return lookup_join(orders, w.withColumnRenamed("date", "purchase_date"), "purchase_date", guard)
    return orders.join(w, orders["purchase_date"] == w["date"], "left").drop(w["date"])


class OrderGuards:
    """The guards of the joins of ``orders_full`` to its two lookups. Payments and
    items are aggregated to one row per order and can't fan out."""

    def __init__(self) -> None:
        self.customers, self.weather = JoinGuard("orders to customers"), JoinGuard("orders to weather")

    def check(self) -> list[JoinAudit]:
        """Raise FanOutError with the offending keys, or tell what was seen."""
        return [self.customers.check(), self.weather.check()]


ORDERS_FULL_COLUMNS = [
    "order_id", "customer_id", "order_status",
    "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date",
    "purchase_date", "delivery_date", "estimated_date", "delivery_days", "was_late", "year", "month",
    "customer_state", "customer_city",
    "total_payment", "payment_count", "item_count", "items_total", "freight_total",
    "temp_max", "precipitation", "rain_category",
]


def orders_full(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    order_items: DataFrame,
    weather: DataFrame,
    guards: OrderGuards | None = None,
    hot_customers: dict | None = None,
) -> DataFrame:
    """The enriched fact table: one row per delivered order.

    ``rain_category`` treats missing precipitation as no rain (the only rule
    the reference writes into this table). With ``guards`` the joins to lookups
    are counted; ``guards.check()`` after the job that runs them.
    """
    df = clean_orders(orders)
    df = join_payments(df, payments)
    df = join_items(df, order_items)
    df = join_customers(df, customers, guards.customers if guards else None, hot_customers)
    df = join_weather(df, weather, guards.weather if guards else None)
    df = df.withColumn("rain_category", rules.rain_category("precipitation", null_policy="no_rain"))
    return df.select(*ORDERS_FULL_COLUMNS)


def orders_full_from(src, guards: OrderGuards | None = None, hot_customers: dict | None = None) -> DataFrame:
    """``orders_full`` from a :class:`mercato.sources.fixtures.Sources`."""
    return orders_full(src.orders, src.customers, src.payments, src.order_items, src.weather, guards, hot_customers)


def write_orders_full(full: DataFrame, path: str) -> DataFrame:
    """Store ``orders_full`` as parquet partitioned by year/month and return
    the stored table.

    This is the transform stage's output: marts, checks, feeds and reports
    read it instead of re-running the joins. Readers get column pruning (a
    mart reads ~6 of 23 columns) and partition pruning (year filters). The
    write is rebalanced on (year, month): AQE splits a month that outgrows
    the advisory partition size into several files written in parallel.
    """
    from mercato.sources import io  # local import: sources depend on operators' schemas only

    io.write_parquet(full, path, ["year", "month"])
    return full.sparkSession.read.schema(full.schema).parquet(path).select(*full.columns)


MONEY_COLUMNS = ("total_payment", "items_total", "freight_total")


def money_as_double(df: DataFrame, columns=MONEY_COLUMNS) -> DataFrame:
    """Money columns as double (they already are; kept for callers that
    pass frames with DECIMAL money)."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns if c in df.columns})


def stg_orders(orders_full_df: DataFrame) -> DataFrame:
    """Staging view: typed columns, NULL metrics -> 0, delivery_status, and
    only orders with a positive payment."""
    z = F.lit(0)
    return orders_full_df.where(
        F.col("order_id").isNotNull()
        & F.col("total_payment").isNotNull()
        & (F.col("total_payment") > 0)
    ).select(
        "order_id", "customer_id", "customer_state", "customer_city",
        F.col("order_purchase_timestamp").alias("purchase_ts"),
        F.col("order_delivered_customer_date").alias("delivered_ts"),
        F.col("order_estimated_delivery_date").alias("estimated_ts"),
        "purchase_date", "delivery_date", "estimated_date",
        F.coalesce("total_payment", z.cast(MONEY)).alias("total_payment"),
        F.coalesce("delivery_days", z).alias("delivery_days"),
        F.coalesce("item_count", z.cast("long")).alias("item_count"),
        F.coalesce("items_total", z.cast(MONEY)).alias("items_total"),
        F.coalesce("freight_total", z.cast(MONEY)).alias("freight_total"),
        "was_late",
        rules.delivery_status("was_late").alias("delivery_status"),
        "year", "month",
        "temp_max",
        F.coalesce("precipitation", F.lit(0.0)).alias("precipitation"),
        "rain_category",
    )


def stg_weather(orders_full_df: DataFrame) -> DataFrame:
    """Distinct weather observations of days that have an order."""
    return (
        orders_full_df.where(F.col("purchase_date").isNotNull())
        .select(
            F.col("purchase_date").alias("weather_date"),
            "temp_max",
            "precipitation",
            "rain_category",
            rules.temp_category("temp_max").alias("temp_category"),
        )
        .distinct()
    )
