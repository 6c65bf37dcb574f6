"""Source / sink round trips.

Each query writes data Spark derives from the given tables to a fresh folder
under the shared checkpoint folder, reads it back with an explicit schema and
returns the read-back table, which the oracle checks against SQL on the
original tables.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators import enrich, incremental, marts, report
from mercato.plans.oracle import with_ctes
from mercato.plans.queries_core import STG_OUT, build_ofull, ofull, out, src, stg
from mercato.plans.registry import query
from mercato.plans.session import materialize, scratch_path
from mercato.sources import fixtures, io, quoted, schemas, versions


@query(
    "scan_csv",
    with_ctes("SELECT order_id, payment_sequential, CAST(payment_value AS DOUBLE) AS payment_value FROM src_payments"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "payments-csv")
    io.write_csv(src(spark, sf).payments, path)
    return io.read_csv(spark, path, schemas.PAYMENTS)


@query("scan_csv_quoted", "SELECT conv_id, turn, role, text FROM conversations")
def q_scan_csv_quoted(spark, sf):
    """Free text with quotes and line breaks as CSV, read back by byte ranges."""
    path = scratch_path(spark, "quoted-csv")
    turns = fixtures.read_table(spark, sf, "conversations")
    io.write_csv(turns, path)
    return quoted.read_quoted_csv(spark, path, turns.schema, empty_text=True)


@query("scan_csv_dates", with_ctes("SELECT * FROM src_orders"))
def q_scan_csv_dates(spark, sf):
    path = scratch_path(spark, "orders-csv")
    io.write_csv(src(spark, sf).orders, path)
    return io.read_csv(spark, path, schemas.ORDERS)


@query("csv_to_parquet", with_ctes("SELECT * FROM src_orders"))
def q_csv_to_parquet(spark, sf):
    csv_path = scratch_path(spark, "orders-text")
    io.write_csv(src(spark, sf).orders, csv_path)
    return io.csv_to_parquet(spark, csv_path, scratch_path(spark, "orders-parquet"))


@query("scan_weather_json", with_ctes('SELECT "date", temp_max, precipitation FROM src_weather'))
def q_scan_weather_json(spark, sf):
    path = scratch_path(spark, "weather-json")
    io.write_weather_json(src(spark, sf).weather, path)
    return io.read_weather_json(spark, path)


@query("sink_csv", with_ctes('SELECT "date", temp_max, precipitation FROM src_weather'))
def q_sink_csv(spark, sf):
    path = scratch_path(spark, "weather-csv")
    io.write_csv(enrich.clean_weather(src(spark, sf).weather), path)
    return io.read_csv(spark, path, schemas.WEATHER)


@query("scan_parquet", with_ctes("SELECT * FROM ofull_out"))
def q_scan_parquet(spark, sf):
    path = scratch_path(spark, "orders-full")
    io.write_parquet(out(ofull(spark, sf)), path)
    return io.read_parquet(spark, path + "/*.parquet")


@query("sink_parquet", with_ctes("SELECT * FROM ofull_out"))
def q_sink_parquet(spark, sf):
    """orders_full from the raw tables, written partitioned by year/month
    (rebalanced: hot months split into several files by AQE)."""
    path = scratch_path(spark, "orders-full-part")
    io.write_parquet(out(build_ofull(spark, sf)), path, ["year", "month"])
    return io.read_parquet(spark, path)


LOADED = ("orders_full", "monthly_revenue", "revenue_by_state", "weather_impact")


@query(
    "sink_table",
    with_ctes(
        "SELECT 'orders_full' AS table_name, COUNT(*) AS n_rows FROM ofull UNION ALL "
        "SELECT 'monthly_revenue', COUNT(*) FROM etl_monthly UNION ALL "
        "SELECT 'revenue_by_state', COUNT(*) FROM etl_state UNION ALL "
        "SELECT 'weather_impact', COUNT(*) FROM etl_weather"
    ))
def q_sink_table(spark, sf):
    """Load the four tables into a catalog database; report rows after load."""
    with _loaded(spark, sf, "mercato_load") as (db, names):
        counts = [
            spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name in names
        ]
        return materialize(reduce(DataFrame.unionByName, counts))


@query(
    "sink_table_replaced",
    with_ctes(
        "SELECT 'before' AS moment, customer_state, total_orders, total_revenue FROM etl_state WHERE customer_state < '2' "
        "UNION ALL SELECT 'after a failed write', customer_state, total_orders, total_revenue FROM etl_state WHERE customer_state < '2' "
        "UNION ALL SELECT 'after', customer_state, total_orders, total_revenue FROM etl_state"
    ))
def q_sink_table_replaced(spark, sf):
    """A summary table as readers see it: before, after a write that failed
    halfway, and after it was replaced."""
    states, folder = marts.revenue_by_state(ofull(spark, sf)), scratch_path(spark, "versions")
    broken = states.withColumn("customer_state", F.when(F.col("customer_state") < "2", F.col("customer_state")).otherwise(F.raise_error(F.lit("stop"))))
    seen = []
    with _database(spark, "mercato_versions") as db:
        for moment, new in (("before", states.filter("customer_state < '2'")), ("after a failed write", broken), ("after", states)):
            try:
                versions.replace_table(new, f"{db}.revenue_by_state", folder)
            except (Py4JError, PySparkException):
                if new is not broken:
                    raise
            table = spark.table(f"{db}.revenue_by_state").select("customer_state", "total_orders", "total_revenue")
            seen.append(materialize(table.select(F.lit(moment).alias("moment"), "*")))
        return reduce(DataFrame.unionByName, seen)


@contextmanager
def _database(spark, prefix):
    """A catalog database of its own, dropped with its tables at the end."""
    db = f"{prefix}_{uuid.uuid4().hex[:8]}"
    io.ensure_database(spark, db, scratch_path(spark, db))
    try:
        yield db
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


@contextmanager
def _loaded(spark, sf, prefix):
    """The four tables in a database of their own: (database, table names)."""
    full = ofull(spark, sf)
    tables = {
        "orders_full": out(full),
        "monthly_revenue": marts.monthly_revenue(full),
        "revenue_by_state": marts.revenue_by_state(full),
        "weather_impact": marts.weather_impact(full),
    }
    with _database(spark, prefix) as db:
        for name, df in tables.items():
            io.save_table(df, f"{db}.{name}")
        yield db, list(tables)


@query("table_catalog")
def q_table_catalog(spark, sf):
    """Load the four tables into a fresh catalog database plus a staging view,
    then list (schema, table_name, table_type). Catalog metadata of the
    session: rows-only check."""
    view = f"stg_orders_{uuid.uuid4().hex[:8]}"
    with _loaded(spark, sf, "mercato_catalog") as (db, _):
        io.create_view(enrich.stg_orders(ofull(spark, sf)), view)
        listing = io.list_tables(spark, [db])
        spark.catalog.dropTempView(view)
        return listing.where((F.col("schema") == db) | (F.col("table_name") == view))


@query("view_staging", with_ctes(f"SELECT {STG_OUT} FROM stg"))
def q_view_staging(spark, sf):
    view = f"stg_orders_{uuid.uuid4().hex[:8]}"
    df = io.create_view(out(stg(spark, sf)), view)  # the plan stays resolved without the name
    spark.catalog.dropTempView(view)
    return df


@query("table_mart", with_ctes("SELECT * FROM mart_monthly"))
def q_table_mart(spark, sf):
    with _database(spark, "marts") as db:
        io.save_table(marts.monthly_revenue_mart(stg(spark, sf)), f"{db}.monthly_revenue")
        return materialize(spark.table(f"{db}.monthly_revenue"))


def _refreshed(spark, sf):
    """Folder of mart parts where a month that was wrong has been replaced."""
    orders, folder = stg(spark, sf), scratch_path(spark, "mart-parts")
    months = [(r.year, r.month) for r in orders.select("year", "month").distinct().collect()]  # as many as partitions
    late = max(months)
    wrong = orders.withColumn("total_payment", F.when(F.col("year") == late[0], F.col("total_payment") * 2).otherwise(F.col("total_payment")))
    incremental.refresh(wrong, months, folder)
    incremental.refresh(orders, [m for m in months if m[0] == late[0]], folder)
    return folder


@query("table_mart_refreshed", with_ctes("SELECT * FROM mart_monthly"))
def q_table_mart_refreshed(spark, sf):
    """The monthly mart merged from its stored parts, after the last year's months
    were replaced; only those were read again."""
    return incremental.monthly_mart(spark, _refreshed(spark, sf))


@query("state_mart_refreshed", with_ctes("SELECT * FROM mart_state"))
def q_state_mart_refreshed(spark, sf):
    """The state mart, merged over all months from the same parts."""
    return incremental.state_mart(spark, _refreshed(spark, sf))


@query(
    "cache_frame",
    with_ctes(
        "SELECT 'monthly_revenue' AS table_name, COUNT(*) AS n_rows, CAST(SUM(total_orders) AS BIGINT) AS total_orders FROM etl_monthly "
        "UNION ALL SELECT 'revenue_by_state', COUNT(*), CAST(SUM(total_orders) AS BIGINT) FROM etl_state"
    ),
)
def q_cache_frame(spark, sf):
    """Two summaries from one cached orders_full, which is released afterwards."""
    with io.cached(ofull(spark, sf)) as full:
        parts = {"monthly_revenue": marts.monthly_revenue(full), "revenue_by_state": marts.revenue_by_state(full)}
        rows = [
            df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_orders").alias("total_orders")).select(
                F.lit(name).alias("table_name"), "n_rows", "total_orders"
            )
            for name, df in parts.items()
        ]
        return materialize(reduce(DataFrame.unionByName, rows))


REPORT_RUN_TIME = "1970-01-01T00:00:00"


@query("sink_report_json")
def q_sink_report_json(spark, sf):
    """Nested JSON report written and read back (rows-only check; fields are
    compared in tests/test_report.py)."""
    full = ofull(spark, sf)
    rep = report.build_report(
        full, marts.revenue_by_state(full), marts.monthly_revenue(full), REPORT_RUN_TIME
    )
    path = scratch_path(spark, "report")
    report.write_report_json(rep, path)
    return spark.read.json(path)
