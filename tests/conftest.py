from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mercato.plans.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app_name="mercato-tests")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def _own_views(request):
    """Temporary views that a test makes go with it; the session is shared."""
    yield
    if "spark" in request.fixturenames:
        catalog = request.getfixturevalue("spark").catalog
        for t in catalog.listTables():
            if t.isTemporary:
                catalog.dropTempView(t.name)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture
def raw(spark):
    """Builder of hand-made raw tables (orders, customers, payments, items, weather)."""
    from mercato.sources import schemas

    def make(orders, customers=(), payments=(), items=(), weather=()):
        return dict(
            orders=spark.createDataFrame(list(orders), schemas.ORDERS),
            customers=spark.createDataFrame(list(customers), schemas.CUSTOMERS),
            payments=spark.createDataFrame(list(payments), schemas.PAYMENTS),
            order_items=spark.createDataFrame(list(items), schemas.ORDER_ITEMS),
            weather=spark.createDataFrame(list(weather), schemas.WEATHER),
        )

    return make
