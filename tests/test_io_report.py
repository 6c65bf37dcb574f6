"""Sources, sinks and the JSON report."""

from __future__ import annotations

import glob
import json
import os

from conftest import SF_SMALL, d
from mercato.operators import enrich, marts, report
from mercato.plans.session import scratch_path
from mercato.sources import fixtures, io, schemas


def local(path: str) -> str:
    """Scratch paths are URIs; Python file calls need the local path."""
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_quoted_newline_and_comma(spark):
    path = scratch_path(spark, "csv-text")
    os.makedirs(local(path), exist_ok=True)
    with open(f"{local(path)}/part.csv", "w") as fh:
        fh.write('customer_id,customer_state,customer_city\n1,SP,"Sao Paulo, centro\nzona 2"\n2,RJ,Rio\n')
    df = io.read_csv(spark, path, schemas.CUSTOMERS, multi_line=True)
    rows = {r.customer_id: r.customer_city for r in df.collect()}
    assert rows == {1: "Sao Paulo, centro\nzona 2", 2: "Rio"}


def test_weather_json_keeps_null_elements(spark):
    path = scratch_path(spark, "weather-doc")
    os.makedirs(local(path), exist_ok=True)
    doc = {"daily": {"time": ["2017-01-01", "2017-01-02", "2017-01-03"],
                     "temperature_2m_max": [30.1, None, 22.0], "precipitation_sum": [0.0, 4.2, None]}}
    with open(f"{local(path)}/doc.json", "w") as fh:
        json.dump(doc, fh, indent=2)  # pretty-printed single document
    got = io.read_weather_json(spark, path, multi_line=True).orderBy("date").collect()
    assert [(r.date, r.temp_max, r.precipitation) for r in got] == [
        (d("2017-01-01"), 30.1, 0.0), (d("2017-01-02"), None, 4.2), (d("2017-01-03"), 22.0, None)
    ]


def test_weather_json_round_trip_one_doc_per_year(spark):
    w = fixtures.weather(spark, SF_SMALL)
    path = scratch_path(spark, "weather-json")
    io.write_weather_json(w, path)
    docs = [json.loads(line) for f in glob.glob(f"{local(path)}/*.json") for line in open(f) if line.strip()]
    years = {doc["daily"]["time"][0][:4] for doc in docs}
    assert docs and len(docs) == len(years)  # one document per calendar year
    assert all(len(doc["daily"]["time"]) <= 366 for doc in docs)
    back = io.read_weather_json(spark, path)
    assert back.exceptAll(enrich.clean_weather(w)).count() == 0 and back.count() == w.count()


def test_partitioned_write_spreads_and_round_trips(spark):
    src = fixtures.load_sources(spark, SF_SMALL)
    full = enrich.orders_full_from(src)
    path = scratch_path(spark, "of-part")
    written = io.write_parquet(full, path, ["year", "month"], spread_key="order_id", files_per_partition=2)
    assert written == full.count()
    parts = glob.glob(f"{local(path)}/year=*/month=*")
    assert parts and all(len(glob.glob(f"{p}/*.parquet")) <= 2 for p in parts)
    back = io.read_parquet(spark, path)
    assert back.count() == full.count()
    pruned = back.where("year = 1997")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_catalog_tables_and_views(spark):
    io.ensure_database(spark, "mercato_test_db", scratch_path(spark, "db"))
    df = spark.range(3).withColumnRenamed("id", "x")
    io.save_table(df, "mercato_test_db.t1")
    io.create_view(df, "mercato_test_view")
    cat = {(r.schema, r.table_name, r.table_type) for r in io.list_tables(spark, ["mercato_test_db"]).collect()}
    assert ("mercato_test_db", "t1", "BASE TABLE") in cat
    assert (None, "mercato_test_view", "VIEW") in cat
    assert spark.table("mercato_test_db.t1").count() == 3


def test_csv_to_parquet_types(spark):
    src = fixtures.load_sources(spark, SF_SMALL)
    csv_path = scratch_path(spark, "orders-text")
    io.write_csv(src.orders, csv_path)
    back = io.csv_to_parquet(spark, csv_path, scratch_path(spark, "orders-pq"))
    assert dict(back.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert back.exceptAll(src.orders).count() == 0 and back.count() == src.orders.count()


def test_report_fields(spark):
    full = enrich.orders_full_from(fixtures.load_sources(spark, SF_SMALL))
    states, monthly = marts.revenue_by_state(full), marts.monthly_revenue(full)
    rep = report.build_report(full, states, monthly, "2020-01-01T00:00:00")
    path = scratch_path(spark, "report")
    report.write_report_json(rep, path)
    files = glob.glob(f"{local(path)}/*.json")
    doc = json.loads(open(files[0]).readline())
    assert doc["pipeline_run_time"] == "2020-01-01T00:00:00"
    kpi = marts.kpi_summary_rate(full).collect()[0].asDict()
    assert doc["key_metrics"] == kpi
    top = [r.asDict() for r in states.select("customer_state", "total_orders", "total_revenue").limit(5).collect()]
    assert doc["top_states"] == top
    trend = [r.asDict() for r in monthly.select("year", "month", "total_orders", "total_revenue").limit(6).collect()]
    assert doc["monthly_trend"] == trend


def test_missing_csv_path_is_an_error(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        io.read_csv(spark, "/nonexistent/mercato/orders.csv", schemas.ORDERS).count()


def test_partitioned_write_splits_a_hot_month(spark):
    """One month holds a third of all rows: the rebalanced write spreads it
    over several files (tasks) instead of one."""
    from pyspark.sql import functions as F

    df = (
        spark.range(0, 240_000, numPartitions=16)
        .select(
            F.lit(2017).alias("year"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 11 + 2).cast("int")).alias("month"),
            F.col("id").alias("order_id"),
            (F.col("id") * 7 % 1000).cast("double").alias("v"),
        )
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = scratch_path(spark, "hot-month")
        assert io.write_parquet(df, path, ["year", "month"]) == 240_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = glob.glob(f"{local(path)}/year=2017/month=1/*.parquet")
    assert len(hot) >= 4  # written by several tasks, not one
    assert io.read_parquet(spark, path).count() == 240_000


def test_raw_folder_with_json_weather(spark):
    src = fixtures.load_sources(spark, SF_SMALL)
    raw = scratch_path(spark, "raw-json")
    io.write_raw_tables(src, raw)
    io.write_weather_json(src.weather, f"{raw}/weather")  # replace the CSV with JSON documents
    back = io.read_raw_tables(spark, raw, states=src.states, weather_format="json")
    expected = enrich.clean_weather(src.weather)
    assert back.weather.count() == expected.count()
    assert back.weather.exceptAll(expected).count() == 0
