"""Hand-built edge rows for every NULL, tie and boundary rule (FIXTURES.md C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import d, ts
from mercato.functions import rules
from mercato.operators import enrich, feeds, marts


def test_rain_buckets_and_null_policy(spark):
    df = spark.createDataFrame([(0.0,), (4.9,), (5.0,), (None,), (-1.0,)], "p double")
    rows = df.select(
        rules.rain_category("p", "heavy").alias("h"), rules.rain_category("p", "no_rain").alias("n")
    ).collect()
    assert [(r.h, r.n) for r in rows] == [
        ("No Rain", "No Rain"),
        ("Light Rain", "Light Rain"),
        ("Heavy Rain", "Heavy Rain"),
        ("Heavy Rain", "No Rain"),
        ("Light Rain", "Light Rain"),
    ]


def test_temperature_categories(spark):
    df = spark.createDataFrame([(30.0,), (29.9,), (22.0,), (21.9,), (None,)], "t double")
    got = [r[0] for r in df.select(rules.temp_category("t")).collect()]
    assert got == ["Hot", "Warm", "Warm", "Cool", "Cool"]


def test_labels_period_month_name(spark):
    df = spark.createDataFrame([(2017, 1, 0), (2018, 11, 1), (None, 3, 2)], "y int, m int, w int")
    rows = df.select(
        rules.period("y", "m").alias("p"), rules.month_name("m").alias("mn"),
        rules.delivery_status("w").alias("ds"), rules.late_label("w").alias("ll"),
    ).collect()
    assert [r.p for r in rows] == ["2017-01", "2018-11", None]
    assert [r.mn for r in rows] == ["Jan", "Nov", "Mar"]
    assert [r.ds for r in rows] == ["On Time", "Late", "On Time"]
    assert [r.ll for r in rows] == ["On Time", "Late", "Unknown"]


def test_lateness_and_delivery_days(raw):
    t = raw(
        orders=[
            # delivered on the estimated day but later in the day -> not late
            (1, 10, "delivered", ts("2017-01-01 10:00:00"), ts("2017-01-10 23:00:00"), ts("2017-01-10 00:00:00")),
            # next day -> late
            (2, 10, "delivered", ts("2017-01-01 10:00:00"), ts("2017-01-11 00:00:00"), ts("2017-01-10 00:00:00")),
            # never delivered -> not late, no delivery days
            (3, 10, "delivered", ts("2017-01-01 10:00:00"), None, ts("2017-01-10 00:00:00")),
            # 23:59 -> 00:01 next day is one calendar day
            (4, 10, "delivered", ts("2017-01-01 23:59:00"), ts("2017-01-02 00:01:00"), ts("2017-01-05 00:00:00")),
            (5, 10, "shipped", ts("2017-01-01 10:00:00"), None, ts("2017-01-10 00:00:00")),
            (6, 10, None, ts("2017-01-01 10:00:00"), None, ts("2017-01-10 00:00:00")),
        ]
    )
    got = {r.order_id: r for r in enrich.clean_orders(t["orders"]).collect()}
    assert sorted(got) == [1, 2, 3, 4]  # only delivered; NULL status dropped
    assert [got[i].was_late for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert got[3].delivery_days is None
    assert got[4].delivery_days == 1
    assert (got[1].year, got[1].month, got[1].purchase_date) == (2017, 1, d("2017-01-01"))


def _two_orders(raw, pay2=None):
    """Order 1: paid 10, delivered in 10 days; order 2: no delivery date."""
    return raw(
        orders=[
            (1, 10, "delivered", ts("2017-01-01 00:00:00"), ts("2017-01-11 00:00:00"), ts("2017-01-20 00:00:00")),
            (2, 11, "delivered", ts("2017-01-02 00:00:00"), None, ts("2017-01-20 00:00:00")),
        ],
        customers=[(10, "SP", "x"), (11, "SP", "y")],
        payments=[(1, 1, 10.0)] + ([(2, 1, pay2)] if pay2 is not None else []),
        items=[(1, 1, 9.0, 1.0)],
        weather=[(d("2017-01-01"), 25.0, 0.0)],
    )


def _full(t):
    return enrich.orders_full(t["orders"], t["customers"], t["payments"], t["order_items"], t["weather"])


def test_left_joins_preserve_rows_and_nulls(raw):
    t = _two_orders(raw)
    full = {r.order_id: r for r in _full(t).collect()}
    assert len(full) == 2
    assert full[1].total_payment == 10.0 and full[1].item_count == 1 and full[1].items_total == 9.0
    assert full[2].total_payment is None and full[2].item_count is None
    assert full[2].temp_max is None and full[2].rain_category == "No Rain"  # missing weather = no rain


def test_undelivered_average_etl_vs_staging(raw):
    t = _two_orders(raw, pay2=20.0)
    full = _full(t)
    etl = marts.monthly_revenue(full).collect()[0]
    assert etl.avg_delivery_days == 10.0  # NULL ignored
    mart = marts.monthly_revenue_mart(enrich.stg_orders(full)).collect()[0]
    assert mart.avg_delivery_days == 5.0  # NULL counted as 0 days
    assert mart.median_order_value == 15.0


def test_staging_payment_filter(raw, spark):
    t = raw(
        orders=[
            (i, 10, "delivered", ts("2017-01-01 00:00:00"), ts("2017-01-03 00:00:00"), ts("2017-01-09 00:00:00"))
            for i in (1, 2, 3)
        ],
        customers=[(10, "SP", "x")],
        payments=[(2, 1, 0.0), (3, 1, 0.01)],
    )
    kept = [r.order_id for r in enrich.stg_orders(_full(t)).collect()]
    assert kept == [3]


def test_weather_average_of_averages(raw):
    orders, pays, weather = [], [], []
    # precipitation 1: one order of 10; precipitation 2: three orders of 20
    specs = [(1, "2017-01-01", 10.0)] + [(i, "2017-01-02", 20.0) for i in (2, 3, 4)]
    for oid, day, amount in specs:
        orders.append((oid, 10, "delivered", ts(f"{day} 00:00:00"), ts(f"{day} 00:00:00"), ts(f"{day} 00:00:00")))
        pays.append((oid, 1, amount))
    weather = [(d("2017-01-01"), 20.0, 1.0), (d("2017-01-02"), 20.0, 2.0)]
    t = raw(orders=orders, customers=[(10, "SP", "x")], payments=pays, weather=weather)
    full = _full(t)
    two_level = {r.rain_category: r for r in marts.weather_impact(full).collect()}
    assert two_level["Light Rain"].avg_order_value == 15.0 and two_level["Light Rain"].total_orders == 4
    weighted = {r.rain_category: r for r in marts.weather_impact_weighted(full).collect()}
    assert weighted["Light Rain"].avg_order_value == 17.5


def test_rank_ties(spark):
    stg = spark.createDataFrame(
        [(1, "A", 5.0), (2, "B", 5.0), (3, "C", 3.0)], "order_id long, customer_state string, total_payment double"
    ).withColumns({"delivery_days": F.lit(1), "was_late": F.lit(0)})
    got = {r.customer_state: r.revenue_rank for r in marts.revenue_by_state_mart(stg).collect()}
    assert got == {"A": 1, "B": 1, "C": 3}


def _state_table(spark, n):
    rows = [(str(i), f"S{i}", float(100 - i)) for i in range(n)]
    return spark.createDataFrame(rows, "customer_state string, state_name string, total_revenue double")


def test_top8_plus_others(spark):
    eight = feeds.state_revenue_share(_state_table(spark, 8)).collect()
    assert len(eight) == 9 and eight[-1].label == "Others" and eight[-1].total_revenue == 0.0
    nine = feeds.state_revenue_share(_state_table(spark, 9)).collect()
    assert nine[-1].label == "Others" and nine[-1].total_revenue == 92.0
    assert abs(sum(r.share_pct for r in nine) - 100.0) < 0.05


def test_search_and_lookup(spark):
    states = spark.createDataFrame([("SP", "São Paulo"), ("RJ", "Rio de Janeiro")], "state_code string, state_name string")
    tbl = spark.createDataFrame([("SP", 1.0), ("RJ", 2.0), ("XX", 3.0)], "customer_state string, total_revenue double")
    named = feeds.lookup_state_name(tbl, states)
    assert {r.customer_state: r.state_name for r in named.collect()} == {
        "SP": "São Paulo", "RJ": "Rio de Janeiro", "XX": "XX"
    }
    assert {r.customer_state for r in feeds.search_states(named, "paulo").collect()} == {"SP"}
    assert {r.customer_state for r in feeds.search_states(named, "rj").collect()} == {"RJ"}
    assert feeds.search_states(named, "").count() == 3


def test_gauge_empty_selection(spark):
    df = spark.createDataFrame([(2017, 0), (2017, 1)], "year int, was_late int")
    empty = feeds.on_time_gauge(df, []).collect()[0]
    assert (empty.total, empty.on_time_pct) == (0, 0.0)
    g = feeds.on_time_gauge(df, [2017]).collect()[0]
    assert (g.total, g.on_time, g.late, g.on_time_pct, g.band) == (2, 1, 1, 50.0, "0-70")


def test_kpis_on_empty_input(spark, raw):
    t = raw(orders=[])
    k = marts.kpi_summary_rate(_full(t)).collect()
    assert len(k) == 1 and k[0].total_orders == 0 and k[0].late_delivery_rate_pct is None


def test_scatter_sample_is_reproducible(spark):
    df = spark.range(5000).select(
        F.col("id").alias("order_id"), F.lit(2017).alias("year"), F.lit(10.0).alias("total_payment"),
        F.lit(20.0).alias("temp_max"), F.lit(0.0).alias("precipitation"), F.lit(0).alias("was_late"),
        F.lit("SP").alias("customer_state"),
    )
    a = feeds.scatter_sample(df, [2017], (0, 100), n=100)
    b = feeds.scatter_sample(df.repartition(7), [2017], (0, 100), n=100)
    assert sorted(r.order_id for r in a.collect()) == sorted(r.order_id for r in b.collect())
    assert a.count() == 100


def test_search_regex_mode(spark):
    tbl = spark.createDataFrame([("SP", "Sao Paulo"), ("RJ", "Rio de Janeiro"), ("MG", None)],
                                "customer_state string, state_name string")
    got = {r.customer_state for r in feeds.search_states(tbl, "^(sp|rj)$", regex=True).collect()}
    assert got == {"SP", "RJ"}
    assert feeds.search_states(tbl, "s.o", regex=True).count() == 1  # 'Sao'; NULL name never matches


def test_results_do_not_depend_on_session_timezone(spark):
    from conftest import SF_SMALL
    from mercato.sources import fixtures

    def run():
        full = enrich.orders_full_from(fixtures.load_sources(spark, SF_SMALL))
        return sorted(tuple(r) for r in marts.monthly_revenue(full).collect())

    before = spark.conf.get("spark.sql.session.timeZone")
    utc = run()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cluster_conf_sizes_partitions():
    from mercato.plans.session import cluster_conf

    conf = cluster_conf(100 * 1024**4, cores=8000)  # 100 TiB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(10 << 20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_approx_median_option(spark):
    stg = spark.range(1, 1002).select(
        F.col("id").alias("order_id"), F.lit(2017).alias("year"), F.lit(1).alias("month"),
        (F.col("id") * 1.0).alias("total_payment"), F.lit(1).alias("delivery_days"),
        F.lit(0).alias("was_late"), F.lit(1).alias("item_count"),
    )
    exact = marts.monthly_revenue_mart(stg).collect()[0].median_order_value
    approx = marts.monthly_revenue_mart(stg, approx_median=True).collect()[0].median_order_value
    assert exact == 501.0 and abs(approx - exact) <= 1.0


def test_cluster_conf_has_no_local_driver_settings():
    from mercato.plans.session import cluster_conf

    conf = cluster_conf(1 << 40, cores=1000)
    assert "spark.driver.host" not in conf and "spark.driver.bindAddress" not in conf
    assert conf["spark.sql.adaptive.enabled"] == "true"
