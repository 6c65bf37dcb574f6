"""Readers and writers.

Reads always use an explicit schema (no inference pass). Writes are
overwrite-mode and go to paths the caller chooses — in jobs, a sub-folder of
the cluster's shared checkpoint folder (see ``plans.session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources import schemas

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"


# ------------------------------------------------------------------ CSV

def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    multi_line: bool = False,
    timestamp_format: str = TS_FORMAT,
    date_format: str = DATE_FORMAT,
) -> DataFrame:
    """Typed CSV scan; malformed values fail the read (FAILFAST) instead of
    silently turning into NULLs.

    With a header, columns are matched by name: the file may hold them in any
    order and have others besides (those are not returned). A declared column
    that the header lacks is an error, and so is a file of the folder whose
    header differs from the first one's.

    Quoted fields with commas are always handled. ``multi_line=True`` also
    keeps quoted newlines in one row, but reads each file in one task; large
    free-text tables are read by byte ranges with ``quoted.read_quoted_csv``."""
    found, check = schema, header
    if header:
        names = (
            spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .csv(path).columns  # reads the first line only
        )
        missing = [c for c in schema.names if c not in names]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {', '.join(names)}")
        found = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in names])
    return (
        spark.read.schema(found)
        .option("enforceSchema", not check)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .option("dateFormat", date_format)
        .csv(path)
        .select(*schema.names)
    )


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", TS_FORMAT)
        .option("timestampFormat", TS_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )


def csv_to_parquet(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    schema: T.StructType = schemas.ORDERS_TEXT,
    timestamp_columns: Sequence[str] = (
        "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    fmt: str = TS_FORMAT,
) -> DataFrame:
    """Orders landed as CSV text -> typed timestamps -> parquet; returns the
    read-back table. Text that does not parse raises (ANSI)."""
    raw = read_csv(spark, csv_path, schema)
    typed = raw.withColumns({c: F.to_timestamp_ntz(F.col(c), F.lit(fmt)) for c in timestamp_columns})
    typed.write.mode("overwrite").parquet(out_path)
    return read_parquet(spark, out_path, typed.schema)


# ------------------------------------------------------------------ weather JSON

def read_weather_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Column-oriented daily weather documents -> one row per day.

    ``arrays_zip`` + ``inline`` pair the parallel arrays element by element;
    NULL elements are kept. Use ``multi_line=True`` for pretty-printed
    single-document files."""
    raw = spark.read.schema(schemas.WEATHER_JSON).option("multiLine", multi_line).json(path)
    return raw.select(
        F.inline(F.arrays_zip("daily.time", "daily.temperature_2m_max", "daily.precipitation_sum"))
    ).toDF("date", "temp_max", "precipitation")


def write_weather_json(weather: DataFrame, path: str) -> None:
    """Write a daily weather table as column-oriented documents, one per
    calendar year (each document holds at most 366 days, so no document
    grows with the table)."""
    days = weather.select(F.to_date("date").alias("date"), "temp_max", "precipitation")
    docs = days.groupBy(F.year("date").alias("_year")).agg(
        F.sort_array(F.collect_list(F.struct("date", "temp_max", "precipitation"))).alias("_d")
    )
    docs.select(
        F.struct(
            F.col("_d.date").alias("time"),
            F.col("_d.temp_max").alias("temperature_2m_max"),
            F.col("_d.precipitation").alias("precipitation_sum"),
        ).alias("daily")
    ).write.mode("overwrite").json(path)


# ------------------------------------------------------------------ parquet

def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a known schema saves the pass over a footer."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    spread_key: str | None = None,
    files_per_partition: int = 1,
    mode: str = "overwrite",
) -> int:
    """Parquet write, optionally partitioned (``partitionBy``).

    Partitioned writes are balanced with the ``REBALANCE`` hint on the
    partition columns: rows of one output partition go to one task, and AQE
    splits a task that grows beyond the advisory partition size (a month
    holding a third of all orders becomes many files written in parallel)
    and coalesces small ones — file sizes stay bounded at any scale without
    a fixed file count or a sampling pass.

    ``spread_key`` + ``files_per_partition`` instead salt the hash on
    ``hash(spread_key) % files_per_partition`` for an explicit upper bound
    of files per partition (for sessions without AQE).

    Returns the number of rows written, observed inside the write job
    (``DataFrame.observe``) instead of a second pass over the data.
    """
    obs = Observation("rows_written")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by and spread_key:
        salt = F.pmod(F.xxhash64(F.col(spread_key)), F.lit(max(1, files_per_partition)))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` kept in memory, spilling to disk, while the block runs; lost blocks
    are computed again."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


# ------------------------------------------------------------------ catalog

def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """CREATE OR REPLACE a catalog table (external when ``path`` is given).
    Row order is not a table property: readers sort."""
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Lazy staging view (no storage)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """(schema, table_name, table_type) for catalog tables and views, sorted.
    Session-scoped temporary views belong to no database: schema is NULL.
    Metadata only; system schemas excluded."""
    dbs = list(databases) if databases else [d.name for d in spark.catalog.listDatabases()]
    rows = set()
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                rows.add((None, t.name, "VIEW"))
            else:
                kind = "VIEW" if (t.tableType or "").upper() == "VIEW" else "BASE TABLE"
                rows.add((t.namespace[0] if t.namespace else db, t.name, kind))
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    return spark.createDataFrame(ordered, "schema string, table_name string, table_type string")


# ------------------------------------------------------------------ raw folders

RAW_TABLES = ("orders", "customers", "payments", "order_items", "weather")


def write_raw_tables(src, folder: str) -> None:
    """Land raw tables as CSV, one sub-folder per table (orders' timestamps
    as text in ``TS_FORMAT``), the layout ``read_raw_tables`` reads."""
    folder = folder.rstrip("/")
    for name in RAW_TABLES:
        write_csv(getattr(src, name), f"{folder}/{name}")


def read_extra_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw tables beside the transform's (reviews, products, sellers,
    geolocation, category names) that the folder holds. Reviews are free text
    with quoted line breaks and are read by byte ranges all the same."""
    from mercato.sources.quoted import read_quoted_csv

    folder = folder.rstrip("/")
    return {
        name: (read_quoted_csv if name == "reviews" else read_csv)(spark, f"{folder}/{name}", schema)
        for name, schema in schemas.EXTRA_SCHEMAS.items()
        if _exists(spark, f"{folder}/{name}")
    }


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_raw_tables(
    spark: SparkSession,
    folder: str,
    states: DataFrame | None = None,
    weather_format: str = "csv",
    text_ids: bool = False,
):
    """Read a folder of raw CSV tables with explicit schemas into
    :class:`mercato.sources.fixtures.Sources`. The weather sub-folder holds
    CSV, column-oriented JSON documents one per line (``"json"``, as
    ``write_weather_json`` writes them), or one pretty-printed document per
    file (``"json_document"``). ``text_ids`` reads every id as text, as the
    public files hold them. ``states`` defaults to the fixed Brazilian
    state dimension."""
    if weather_format not in ("csv", "json", "json_document"):
        raise ValueError("weather_format must be 'csv', 'json' or 'json_document'")
    from mercato.sources.fixtures import Sources

    folder = folder.rstrip("/")
    ids = schemas.text_ids if text_ids else lambda schema: schema
    if states is None:
        from mercato.operators.feeds import state_dimension

        states = state_dimension(spark)
    return Sources(
        orders=read_csv(spark, f"{folder}/orders", ids(schemas.ORDERS)),
        customers=read_csv(spark, f"{folder}/customers", ids(schemas.CUSTOMERS)),
        payments=read_csv(spark, f"{folder}/payments", ids(schemas.PAYMENTS)),
        order_items=read_csv(spark, f"{folder}/order_items", ids(schemas.ORDER_ITEMS)),
        weather=(
            read_csv(spark, f"{folder}/weather", schemas.WEATHER)
            if weather_format == "csv"
            else read_weather_json(spark, f"{folder}/weather", multi_line=weather_format == "json_document")
        ),
        states=states,
    )
