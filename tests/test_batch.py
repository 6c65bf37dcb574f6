"""The end-to-end batch on the smallest fixture."""

from __future__ import annotations

import glob
import json

import pytest

from conftest import SF_SMALL
from mercato.operators import quality
from mercato.plans.batch import run_batch
from mercato.plans.session import scratch_path
from mercato.sources import fixtures


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_batch_runs_every_stage(spark):
    out = scratch_path(spark, "batch")
    src = fixtures.load_sources(spark, SF_SMALL)
    res = run_batch(spark, src, out, "2020-01-01T00:00:00", database="mercato_batch_test", raise_on_failure=False)
    assert res.rows_written["orders_full"] == src.orders.where("order_status = 'delivered'").count()
    assert res.rows_written["monthly_revenue"] > 1 and res.rows_written["weather_impact"] == 3
    # the fixtures have delivered orders without line items: NULL payments are reported
    assert res.checks["null_counts"] == 1 and res.checks["not_null"] > 0
    assert res.checks["row_counts"] == 0 and res.checks["unique"] == 0 and res.checks["accepted_values"] == 0
    assert spark.table("mercato_batch_test.monthly_revenue_mart").count() == res.rows_written["monthly_revenue_mart"]
    doc = json.loads(open(glob.glob(_local(res.report_path) + "/*.json")[0]).readline())
    assert doc["key_metrics"]["total_orders"] == res.rows_written["orders_full"]
    assert len(doc["top_states"]) == 5 and len(doc["monthly_trend"]) == 6


def test_batch_raises_on_failed_checks(spark):
    src = fixtures.load_sources(spark, SF_SMALL)
    with pytest.raises(quality.DataQualityError) as e:
        run_batch(spark, src, scratch_path(spark, "batch-fail"), "2020-01-01T00:00:00", database="mercato_batch_fail")
    assert "null_counts" in str(e.value)


def test_batch_from_raw_csv_folder_matches_fixture_run(spark):
    """The real-data path: raw tables landed as CSV, read back with explicit
    schemas, and the batch's marts equal the ones built from the fixtures."""
    from mercato.operators import enrich, marts
    from mercato.sources import io

    src = fixtures.load_sources(spark, SF_SMALL)
    raw = scratch_path(spark, "raw-csv")
    io.write_raw_tables(src, raw)
    back = io.read_raw_tables(spark, raw, states=src.states)
    res = run_batch(spark, back, scratch_path(spark, "batch-csv"), "2020-01-01T00:00:00",
                    database="mercato_batch_csv", raise_on_failure=False)
    expected = marts.monthly_revenue_mart(enrich.stg_orders(enrich.orders_full_from(src)))
    got = spark.table("mercato_batch_csv.monthly_revenue_mart")
    assert got.count() == expected.count() == res.rows_written["monthly_revenue_mart"]
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_cli_runs_the_batch(spark, capsys):
    from mercato.__main__ import main
    from mercato.sources import io

    raw = scratch_path(spark, "raw-cli")
    io.write_raw_tables(fixtures.load_sources(spark, SF_SMALL), raw)
    code = main(["--raw", raw, "--out", scratch_path(spark, "cli-out"), "--run-time", "2020-01-01T00:00:00",
                 "--database", "mercato_cli"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 2 and out["status"] == "failed"  # fixtures carry NULL payments
    assert any("null_counts" in f for f in out["failures"])


def test_catalog_after_a_run(spark, tmp_path):
    """orders_full and both staging views are in the database, with the rows of
    their DataFrame functions."""
    from conftest import SF_SMALL
    from mercato.operators import enrich, quality
    from mercato.plans.batch import run_batch
    from mercato.sources import fixtures

    src = fixtures.load_sources(spark, SF_SMALL)
    run_batch(spark, src, str(tmp_path), "2024-01-01T00:00:00", database="catalog_test", raise_on_failure=False)
    try:
        assert {t.name for t in spark.catalog.listTables("catalog_test")} >= {"orders_full", "stg_orders", "stg_weather", "monthly_revenue"}
        full = spark.table("catalog_test.orders_full")
        for name, want in (("stg_orders", enrich.stg_orders(full)), ("stg_weather", enrich.stg_weather(full))):
            got = spark.table(f"catalog_test.{name}")
            assert got.columns == want.columns and got.count() > 0
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.sql("DROP DATABASE catalog_test CASCADE")
    bad = spark.sql("SELECT raise_error('broken check') AS x FROM range(1)").filter("x IS NULL")
    counts = quality.run_checks({"ok": spark.range(0), "bad": bad}, raise_on_failure=False)
    assert counts["ok"] == 0 and (counts["bad"] == 1 or "broken check" in counts.failures[0])
