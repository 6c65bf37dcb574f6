"""Explicit schemas of the raw inputs (no schema inference at read time)."""

from pyspark.sql import types as T

# Money is a double; sums are exact for amounts in cents (functions/money.py).
MONEY = T.DoubleType()

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.TimestampNTZType()),
    T.StructField("order_delivered_customer_date", T.TimestampNTZType()),
    T.StructField("order_estimated_delivery_date", T.TimestampNTZType()),
])

# Orders as landed in CSV: timestamps still text (converted by csv_to_parquet).
ORDERS_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
    for f in ORDERS.fields
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_state", T.StringType()),
    T.StructField("customer_city", T.StringType()),
])

PAYMENTS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("payment_sequential", T.IntegerType()),
    T.StructField("payment_value", MONEY),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("price", MONEY),
    T.StructField("freight_value", MONEY),
])

WEATHER = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("temp_max", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
])

# Column-oriented daily weather document: a struct of parallel arrays.
WEATHER_JSON = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.DateType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    ])),
])

STATES = T.StructType([
    T.StructField("state_code", T.StringType()),
    T.StructField("state_name", T.StringType()),
])

RAW_SCHEMAS = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "payments": PAYMENTS,
    "order_items": ORDER_ITEMS,
    "weather": WEATHER,
}


def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


# The raw tables the transform does not read. Ids are text. names
# as in the public files.
EXTRA_SCHEMAS = {
    "reviews": T.StructType(
        _fields(T.StringType(), "review_id order_id")
        + _fields(T.IntegerType(), "review_score")
        + _fields(T.StringType(), "review_comment_title review_comment_message")
        + _fields(T.TimestampNTZType(), "review_creation_date review_answer_timestamp")
    ),
    "products": T.StructType(
        _fields(T.StringType(), "product_id product_category_name")
        + _fields(
            T.DoubleType(),
            "product_name_lenght product_description_lenght product_photos_qty product_weight_g "
            "product_length_cm product_height_cm product_width_cm",
        )
    ),
    "category_names": T.StructType(_fields(T.StringType(), "product_category_name product_category_name_english")),
    "sellers": T.StructType(_fields(T.StringType(), "seller_id seller_zip_code_prefix seller_city seller_state")),
    "geolocation": T.StructType(
        _fields(T.StringType(), "geolocation_zip_code_prefix")
        + _fields(T.DoubleType(), "geolocation_lat geolocation_lng")
        + _fields(T.StringType(), "geolocation_city geolocation_state")
    ),
}


def text_ids(schema: T.StructType) -> T.StructType:
    """The schema with every whole-number id as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType()) if f.name.endswith("_id") and isinstance(f.dataType, T.LongType) else f
        for f in schema.fields
    ])
