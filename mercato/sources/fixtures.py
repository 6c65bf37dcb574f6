"""Adapter: the driver's TPC-H-style tables -> the marketplace raw tables.

Every raw table is a lazy projection / aggregation of the given parquet tables,
so column pruning and filters reach the parquet scans and the work grows with
the data. Rules (see FIXTURES.md B):

  orders       o_orderkey, o_custkey; status 'F' -> 'delivered';
               delivered = order date + min(l_quantity) days (NULL without lines);
               estimated = order date + 12 + 3 * priority digit days
  customers    c_custkey, state = c_nationkey as text, city = c_mktsegment
  payments     one per line: price + freight (exact decimals)
  order_items  one per line: price = l_extendedprice, freight = l_tax * l_quantity
  weather      one row per ship day from 1996-01-01: temp 8 + sum(partkey) % 30,
               precipitation max(0, sum(linenumber) % 16 - 8)
  states       nation: code = n_nationkey as text, name = n_name
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.money import cents, from_cents

# Fixed values of the adapter (FIXTURES.md B).
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
ESTIMATE_BASE_DAYS = 12
ESTIMATE_DAYS_PER_PRIORITY = 3
WEATHER_FROM = "1996-01-01"
TEMP_BASE, TEMP_MOD = 8, 30
RAIN_MOD, RAIN_SHIFT = 16, 8


@dataclass(frozen=True)
class Sources:
    orders: DataFrame
    customers: DataFrame
    payments: DataFrame
    order_items: DataFrame
    weather: DataFrame
    states: DataFrame


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


# Schemas of the driver's tables. Reading with an explicit schema skips the
# footer-reading job Spark otherwise runs for every parquet read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(_schema(TABLE_SCHEMAS[name]))
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _price_cents():
    return cents(F.col("l_extendedprice"))


def _freight_cents():
    return cents(F.col("l_tax")) * F.col("l_quantity").cast("long")


def orders(spark: SparkSession, sf_dir: str, li: DataFrame | None = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    li = li if li is not None else read_table(spark, sf_dir, "lineitem")
    lead = li.groupBy("l_orderkey").agg(F.min("l_quantity").cast("int").alias("_lead_days"))
    status = (
        F.when(F.col("o_orderstatus") == "F", STATUS_BY_CODE["F"])
        .when(F.col("o_orderstatus") == "O", STATUS_BY_CODE["O"])
        .otherwise(STATUS_BY_CODE["P"])
    )
    est_days = F.lit(ESTIMATE_BASE_DAYS) + F.lit(ESTIMATE_DAYS_PER_PRIORITY) * F.substring(
        "o_orderpriority", 1, 1
    ).cast("int")
    return (
        o.join(lead, o.o_orderkey == lead.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.timestamp_add("DAY", F.col("_lead_days"), F.col("o_orderdate")).alias(
                "order_delivered_customer_date"
            ),
            F.timestamp_add("DAY", est_days, F.col("o_orderdate")).alias("order_estimated_delivery_date"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_city"),
    )


def payments(spark: SparkSession, sf_dir: str, li: DataFrame | None = None) -> DataFrame:
    li = li if li is not None else read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        from_cents(_price_cents() + _freight_cents()).alias("payment_value"),
    )


def order_items(spark: SparkSession, sf_dir: str, li: DataFrame | None = None) -> DataFrame:
    li = li if li is not None else read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        from_cents(_price_cents()).alias("price"),
        from_cents(_freight_cents()).alias("freight_value"),
    )


def weather(spark: SparkSession, sf_dir: str, li: DataFrame | None = None) -> DataFrame:
    li = li if li is not None else read_table(spark, sf_dir, "lineitem")
    return (
        li.where(F.col("l_shipdate") >= F.lit(WEATHER_FROM).cast("timestamp_ntz"))
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(
            (F.lit(TEMP_BASE) + F.sum("l_partkey") % TEMP_MOD).cast("double").alias("temp_max"),
            F.greatest(F.lit(0), F.sum("l_linenumber") % RAIN_MOD - RAIN_SHIFT)
            .cast("double")
            .alias("precipitation"),
        )
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("state_code"),
        F.col("n_name").alias("state_name"),
    )


def land(df: DataFrame, path: str) -> DataFrame:
    """Write a derived input once (the extract stage's landed file) and
    return a reader over it: later jobs read the small file instead of
    re-deriving it, and the planner sees its real size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    li = read_table(spark, sf_dir, "lineitem")
    return Sources(
        orders=orders(spark, sf_dir, li),
        customers=customers(spark, sf_dir),
        payments=payments(spark, sf_dir, li),
        order_items=order_items(spark, sf_dir, li),
        weather=weather(spark, sf_dir, li),
        states=states(spark, sf_dir),
    )
