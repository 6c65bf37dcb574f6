"""Data-quality checks must find seeded violations (each only its own), and
profiling rules for NULL / NaN / empty tables."""

from __future__ import annotations

import pytest

from mercato.operators import profile, quality


@pytest.fixture
def dq_tables(spark):
    full = spark.createDataFrame(
        [
            (1, 10, 5.0, "SP", 0, "No Rain"),
            (1, 11, 6.0, "RJ", 0, "No Rain"),      # duplicate id
            (2, 12, 7.0, None, 0, "Light Rain"),   # NULL state
            (3, 13, 8.0, "MG", 2, "Heavy Rain"),   # was_late 2
            (4, 14, 9.0, "MG", 1, "Snow"),         # unknown rain category
            (5, 15, 9.0, "MG", None, None),        # NULLs pass accepted_values
        ],
        "order_id long, customer_id long, total_payment double, customer_state string, was_late int, "
        "rain_category string",
    )
    return {"orders_full": full}


def test_dq_checks_find_only_their_violation(dq_tables):
    nn = quality.dq_not_null(dq_tables, [("orders_full", "order_id", "customer_state")]).collect()
    assert [(r.column_name, r.row_key) for r in nn] == [("customer_state", "2")]
    uq = quality.dq_unique(dq_tables, [("orders_full", "order_id")]).collect()
    assert [(r.row_key, r.bad_value) for r in uq] == [("1", "2")]
    av = quality.dq_accepted_values(
        dq_tables,
        [("orders_full", "order_id", "was_late", [0, 1]),
         ("orders_full", "order_id", "rain_category", ["No Rain", "Light Rain", "Heavy Rain"])],
    ).collect()
    assert sorted((r.column_name, r.row_key, r.bad_value) for r in av) == [
        ("rain_category", "4", "Snow"), ("was_late", "3", "2")
    ]


def test_late_rate_bounds_and_revenue(spark):
    states = spark.createDataFrame(
        [("A", 50.0, 1), ("B", 50.01, 2), ("C", -0.01, 3)], "customer_state string, late_rate_pct double, revenue_rank int"
    )
    assert sorted(r.customer_state for r in quality.dq_late_rate_range(states).collect()) == ["B", "C"]
    assert quality.dq_top_state(states, "A").count() == 0
    assert quality.dq_top_state(states, "B").count() == 1
    assert quality.dq_top_state(states, "ZZ").count() == 0  # absent state passes
    months = spark.createDataFrame([("2017-01", 0.0), ("2017-02", 1.0)], "period string, total_revenue double")
    assert [r.period for r in quality.dq_positive_revenue(months).collect()] == ["2017-01"]


def test_row_counts_and_null_counts(spark):
    empty = spark.createDataFrame([], "order_id long, total_payment double, customer_state string")
    full = spark.createDataFrame([(1, None, "SP"), (2, 3.0, None)], "order_id long, total_payment double, customer_state string")
    rc = quality.dq_row_counts({"a": full, "b": empty}).collect()
    assert [(r.table_name, r.has_rows) for r in rc] == [("b", 0)]
    nc = {r.column_name: r.null_count for r in quality.dq_null_counts(full).collect()}
    assert nc == {"null_payments": 1, "null_states": 1}
    assert quality.null_counts(empty).collect()[0].asDict() == {
        "null_order_ids": 0, "null_payments": 0, "null_states": 0
    }


def test_run_checks_raises_with_all_failures(spark):
    bad = spark.createDataFrame([(1,)], "x int")
    good = spark.createDataFrame([], "x int")
    with pytest.raises(quality.DataQualityError) as e:
        quality.run_checks({"good": good, "bad": bad, "broken": spark.range(1).where("assert_true(id < 0) IS NULL")})
    assert "bad: 1 violating rows" in str(e.value)
    assert "broken: query error" in str(e.value)
    assert quality.run_checks({"good": good}) == {"good": 0}


def test_profile_nulls_nan_and_empty(spark):
    df = spark.createDataFrame(
        [(1, None, float("nan"), "a"), (2, None, 1.5, None)], "id long, allnull double, x double, s string"
    )
    prof = {r.column_name: r for r in profile.table_profile(df).collect()}
    assert prof["allnull"].null_count == 2 and prof["allnull"].null_pct == 100.0
    assert prof["x"].null_count == 1  # NaN counts as missing
    assert prof["s"].data_type == "string" and prof["id"].n_cols == 4 and prof["id"].n_rows == 2
    sums = {r.column_name: r.total for r in profile.numeric_sums(df).collect()}
    assert sums["allnull"] == 0.0 and sums["id"] == 3.0 and "s" not in sums
    empty = df.limit(0)
    pe = {r.column_name: r for r in profile.table_profile(empty).collect()}
    assert pe["id"].n_rows == 0 and pe["id"].null_pct is None


def test_cross_table_totals(spark):
    a = spark.createDataFrame([(1, 2.5), (2, 2.5)], "k long, v double")
    b = spark.createDataFrame([(10,)], "k long")
    totals = {(r.column_name, r.source): r.total for r in profile.cross_file_totals({"a": a, "b": b}).collect()}
    assert totals == {("k", "a"): 3.0, ("k", "b"): 10.0, ("k", None): 13.0, ("v", "a"): 5.0, ("v", None): 5.0}
    rc = {r.table_name: r.n_rows for r in profile.row_counts({"a": a, "b": b}).collect()}
    assert rc == {"a": 2, "b": 1, None: 3}
    g = {r.column_name: (r.grand_total, r.n_tables) for r in profile.grand_numeric_totals({"a": a, "b": b}).collect()}
    assert g == {"k": (13.0, 2), "v": (5.0, 1)}


def test_profile_of_tables_samples_merge_and_scan_once(spark, tmp_path):
    import hashlib
    import json

    rows = [(i, f"t{i}", None if i % 4 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, name string, amount double").repartition(7)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "t"))
    empty = stored.limit(0)
    found = profile.profile_tables({"t": stored, "e": empty}, {"t": ["id"], "e": ["id"]})
    got = {(r.table_name, r.column_name): r for r in found.collect()}
    digests = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, _, _ in rows)
    want = [min((d, i) for d, i in digests if lo <= d < hi)[1] for lo, hi in (("0", "55555555"), ("55555555", "aaaaaaaa"), ("aaaaaaaa", "g"))]
    for column in df.columns:
        sample = [json.loads(r) for r in got["t", column].sample_rows]
        assert [s["id"] for s in sample] == want and all(s["name"] == f"t{s['id']}" for s in sample)
    amount = got["t", "amount"]
    assert (amount.null_count, amount.null_pct, amount.total, amount.n_rows, amount.n_cols, amount.position) == (150, 75.0, 4900.0, 200, 3, 3)
    assert got["t", "name"].total is None and got["e", "id"].sample_rows == [] and got["e", "id"].null_pct is None
    plan = profile.profile_tables({"t": stored}, {"t": ["id"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_every_table_profile_against_the_oracle(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from oracle_check import compare, duck

    name = "tables_profile"
    r = compare(spark, duck(SF_SMALL), name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["ok"] and r["rows"] == 101, r
