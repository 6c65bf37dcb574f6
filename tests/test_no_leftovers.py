"""Queries that use the catalog, views or the cache leave none of it behind."""

from __future__ import annotations

from conftest import SF_SMALL
from mercato.plans.registry import QUERIES, load_all

load_all()


def test_catalog_views_and_cache_are_as_before(spark):
    def state():
        catalog = spark.catalog
        views = {t.name for t in catalog.listTables() if t.isTemporary}
        return {d.name for d in catalog.listDatabases()}, views, spark.sparkContext._jsc.getPersistentRDDs().size()

    before = state()
    for name in ("sink_table", "table_catalog", "table_mart", "view_staging", "stg_weather", "cache_frame"):
        assert QUERIES[name](spark, SF_SMALL).count() > 0
    assert state() == before
