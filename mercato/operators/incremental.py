"""Marts kept up month by month.

Beside the marts lie their mergeable parts, one set of rows per month and state:
counts, exact sums, and the counts of the distinct payments that a median needs.
``refresh`` makes the parts of the named months anew, reading those months of the
staged orders only, and replaces their partitions; all other months stay as they
are. ``monthly_mart`` and ``state_mart`` merge the parts and equal the marts built
from all orders, medians included.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.functions.median import exact_median
from mercato.functions.money import cents, from_cents, present
from mercato.plans.joins import join_on_keys

SUMS = (
    "customer_state string, orders long, payments long, cents long, rest double, days long, day_rows long, "
    "late long, items long, item_rows long, year int, month int"
)
PAYMENTS = "customer_state string, payment double, n long, year int, month int"
Month = tuple[int | None, int | None]


def _of_months(stg: DataFrame, months: Iterable[Month]) -> DataFrame:
    """Orders of these months; on a table partitioned by them the others aren't read."""
    wanted = F.lit(False)
    for year, month in months:
        y = F.col("year").isNull() if year is None else F.col("year") == year
        m = F.col("month").isNull() if month is None else F.col("month") == month
        wanted = wanted | (y & m)
    return stg.where(wanted)


def month_sums(stg: DataFrame) -> DataFrame:
    """Mergeable counts and sums per month and state (columns SUMS)."""
    paid = present("total_payment")
    return stg.groupBy("customer_state", "year", "month").agg(
        F.count("order_id").alias("orders"), F.count(paid).alias("payments"),
        F.sum(cents(paid)).alias("cents"), F.sum(paid - from_cents(cents(paid))).alias("rest"),
        F.sum("delivery_days").cast("long").alias("days"), F.count("delivery_days").alias("day_rows"),
        F.sum("was_late").cast("long").alias("late"),
        F.sum("item_count").cast("long").alias("items"), F.count("item_count").alias("item_rows"),
    )


def month_payments(stg: DataFrame) -> DataFrame:
    """How often each payment occurs per month and state (columns PAYMENTS)."""
    paid = present("total_payment").alias("payment")
    rows = stg.select("customer_state", paid, "year", "month").filter("payment is not null")
    return rows.groupBy("customer_state", "payment", "year", "month").agg(F.count(F.lit(1)).alias("n"))


def refresh(stg: DataFrame, months: Iterable[Month], folder: str) -> None:
    """Make the parts of these months anew. A month without orders loses its parts."""
    spark, months = stg.sparkSession, list(months)
    changed = _of_months(stg, months)
    # a row of nothing for each month, so that its partition is replaced in any case
    nothing = spark.createDataFrame(months, "year int, month int")
    for name, parts, schema in (("sums", month_sums(changed), SUMS), ("payments", month_payments(changed), PAYMENTS)):
        names = [c.split()[0] for c in schema.split(", ")]
        rows = parts.unionByName(nothing, allowMissingColumns=True).select(*names).hint("rebalance", "year", "month")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(f"{folder}/{name}")


def _parts(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    counted = "orders" if name == "sums" else "n"
    return spark.read.schema(schema).parquet(f"{folder}/{name}").where(F.col(counted).isNotNull())


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    added = ("orders", "payments", "cents", "rest", "days", "day_rows", "late", "items", "item_rows")
    out = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in added])
    revenue = from_cents("cents") + F.col("rest")
    return out.select(
        *keys,
        F.col("orders").alias("total_orders"),
        F.round(revenue, 2).alias("total_revenue"),
        revenue.alias("_revenue"),
        F.round(F.try_divide(revenue, F.col("payments")), 2).alias("avg_order_value"),
        F.round(F.try_divide(F.col("days").cast("double"), F.col("day_rows")), 1).alias("avg_delivery_days"),
        F.col("late").alias("late_deliveries"),
        F.round(F.try_divide(F.col("late").cast("double") * F.lit(100.0), F.col("orders")), 2).alias("late_rate_pct"),
        F.round(F.try_divide(F.col("items").cast("double"), F.col("item_rows")), 1).alias("avg_items_per_order"),
    )


def _with_median(spark: SparkSession, folder: str, merged: DataFrame, keys: list[str]) -> DataFrame:
    payments = _parts(spark, folder, "payments", PAYMENTS)
    return join_on_keys(merged, exact_median(payments, keys, "payment", out="_median", width=655.36, weight="n"), keys)


def monthly_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly mart (see ``marts.monthly_revenue_mart``) from the parts."""
    keys = ["year", "month"]
    merged = _merged(_parts(spark, folder, "sums", SUMS), keys)
    return _with_median(spark, folder, merged, keys).select(
        "year", "month", rules.period("year", "month").alias("period"),
        "total_orders", "total_revenue", "avg_order_value", F.round("_median", 2).alias("median_order_value"),
        "avg_delivery_days", "late_deliveries", "late_rate_pct", "avg_items_per_order",
    ).orderBy("year", "month")


def state_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The state mart (see ``marts.revenue_by_state_mart``) from the parts."""
    keys = ["customer_state"]
    merged = _merged(_parts(spark, folder, "sums", SUMS).where("customer_state is not null"), keys)
    rank = F.rank().over(Window.orderBy(F.desc("_revenue")))  # one row per state: bounded
    return _with_median(spark, folder, merged, keys).select(
        "customer_state", "total_orders", "total_revenue", "avg_order_value", F.round("_median", 2).alias("median_order_value"),
        "avg_delivery_days", "late_deliveries", "late_rate_pct", rank.alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"), "customer_state")
