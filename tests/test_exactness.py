"""No digit, row or newer input is lost on the way."""

from __future__ import annotations

import datetime as dt
import shutil
from types import SimpleNamespace

import pytest

from conftest import SF_CHECK, SF_SMALL
from mercato.functions.money import money_avg, money_sum
from mercato.operators import marts, profile
from mercato.plans.registry import QUERIES, load_all
from mercato.plans.session import checkpoint_dir
from mercato.sources import io
from pyspark.sql import functions as F
from pyspark.sql import types as T

load_all()


def test_sums_keep_digits_below_a_cent_and_skip_nan(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    df = df.unionByName(spark.createDataFrame([(float("nan"),), (None,)], "x double"))
    row = df.agg(F.round(money_sum("x"), 2).alias("s"), F.round(money_avg("x"), 6).alias("a")).first()
    assert (row.s, row.a) == (4.0, 0.004)
    assert spark.createDataFrame([(None,)], "x double").agg(money_sum("x")).first()[0] is None
    assert spark.createDataFrame([(1e300,), (2.5,)], "x double").agg(money_sum("x")).first()[0] == 1e300


def test_audit_sums_keep_small_values(spark):
    df = spark.range(1000).select(F.lit(0.0000004).alias("lat"), F.lit(2).alias("n"))
    got = {r.column_name: r.total for r in profile.numeric_sums(df).collect()}
    assert got["lat"] == pytest.approx(0.0004, rel=1e-9) and got["n"] == 2000.0
    across = {r.column_name: r.grand_total for r in profile.grand_numeric_totals({"a": df, "b": df}).collect()}
    assert across["lat"] == pytest.approx(0.0008, rel=1e-9)


def test_csv_keeps_fractions_of_a_second(spark, tmp_path):
    schema = T.StructType([T.StructField("t", T.TimestampNTZType())])
    rows = [(dt.datetime(2018, 1, 2, 1, 2, 3, 500000),), (dt.datetime(2018, 1, 2, 1, 2, 3),)]
    io.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in io.read_csv(spark, str(tmp_path / "c"), schema).collect()) == sorted(rows)
    (tmp_path / "d.csv").write_text("t\n2018-01-02 01:02:03\n2018-01-02 01:02:03.5\n")
    assert sorted(tuple(r) for r in io.read_csv(spark, str(tmp_path / "d.csv"), schema).collect()) == sorted(rows)


def test_fractional_weather_is_averaged_alike_under_any_partitioning(spark):
    stg = spark.range(50_000).select(
        F.col("id").alias("order_id"), F.lit("No Rain").alias("rain_category"), F.lit(1.0).alias("total_payment"),
        ((F.col("id") * 7919) % 400 / 10.0).alias("temp_max"), ((F.col("id") * 104729) % 93 / 10.0).alias("precipitation"),
    )
    got = {tuple(marts.weather_impact_mart(stg.repartition(n)).first()) for n in (1, 3, 7)}
    assert len(got) == 1


def test_feeds_cover_all_orders(spark):
    paid = QUERIES["order_subset"](spark, SF_CHECK).count()
    assert QUERIES["delivery_histogram"](spark, SF_CHECK).agg(F.sum("orders")).first()[0] == paid
    assert QUERIES["on_time_gauge"](spark, SF_CHECK).first().total == paid
    years = {r.year for r in QUERIES["distinct_years"](spark, SF_CHECK).collect()}
    assert {r.period[:4] for r in QUERIES["feed_trend"](spark, SF_CHECK).collect()} == {str(y) for y in years}
    heat = QUERIES["orders_heatmap"](spark, SF_CHECK).collect()
    assert {r.year for r in heat} == years and len(heat) == len(years) * len({r.month for r in heat})


def test_replaced_input_changes_the_next_result(spark, tmp_path):
    folder = tmp_path / "tables"
    shutil.copytree(SF_SMALL, folder)
    folder.chmod(0o755)
    before = QUERIES["kpi_summary"](spark, str(folder)).first().total_orders
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").orderBy("o_orderkey").limit(100).toPandas()
    (folder / "orders.parquet").chmod(0o644)
    (folder / "orders.parquet").unlink()
    orders.to_parquet(folder / "orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    after = QUERIES["kpi_summary"](spark, str(folder)).first().total_orders
    assert 0 < after < before


def test_a_cluster_without_shared_storage_is_an_error():
    def session(master):
        conf = SimpleNamespace(get=lambda key, default=None: default)
        context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master=master)
        return SimpleNamespace(sparkContext=context, conf=conf)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master))
