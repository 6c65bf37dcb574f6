"""Raw files as they are published: text ids, more columns, any column order."""

from __future__ import annotations

import pytest

from mercato.operators import enrich
from mercato.sources import io, schemas

FILES = {
    "orders": (
        "customer_id,order_id,order_status,order_approved_at,order_delivered_carrier_date,order_purchase_timestamp,"
        "order_estimated_delivery_date,order_delivered_customer_date\n"
        "c9f,e48a,delivered,2018-01-01 09:10:00,2018-01-03 10:00:00,2018-01-01 09:00:00,2018-01-20 00:00:00,2018-01-11 08:00:00.5\n"
        'c0a,53cd,shipped,,,2018-02-01 09:00:00,2018-02-20 00:00:00,\n'
    ),
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc9f,u1,01409,sao paulo,SP\nc0a,u2,20000,rio,RJ\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\ne48a,1,credit_card,8,99.33\ne48a,2,voucher,1,0.67\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\ne48a,1,p1,s1,2018-01-05 00:00:00,90.0,10.0\n",
    "weather": "date,precipitation,temp_max\n2018-01-01,0.4,29.5\n",
    "reviews": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,e48a,5,ok,"first line\nsecond, ""quoted"" line",2018-01-12 00:00:00,2018-01-13 01:02:03\n'
    ),
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n01037,-23.54562128115268,-46.63929204800168,sao paulo,SP\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
    return str(tmp_path)


def test_columns_go_by_name_and_ids_stay_text(spark, folder):
    src = io.read_raw_tables(spark, folder, text_ids=True)
    row = enrich.orders_full_from(src).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.order_id, r.customer_state, r.customer_city, r.total_payment, r.payment_count) == ("e48a", "SP", "sao paulo", 100.0, 2)
    assert (r.items_total, r.delivery_days, r.temp_max, r.precipitation) == (90.0, 10, 29.5, 0.4)
    assert r.order_delivered_customer_date.microsecond == 500000


def test_extra_tables(spark, folder):
    extra = io.read_extra_tables(spark, folder)
    assert set(extra) == {"reviews", "geolocation"}
    assert extra["reviews"].first().review_comment_message == 'first line\nsecond, "quoted" line'
    assert extra["geolocation"].first().geolocation_lat == -23.54562128115268


def test_wrong_headers_fail(spark, folder, tmp_path):
    (tmp_path / "payments" / "part.csv").write_text("order_id,payment_sequential,amount\ne48a,1,3\n")
    with pytest.raises(ValueError, match="payment_value"):
        io.read_csv(spark, f"{folder}/payments", schemas.text_ids(schemas.PAYMENTS))
    (tmp_path / "weather" / "zz.csv").write_text("date,temp_max,precipitation\n2018-01-02,20.0,0.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv(spark, f"{folder}/weather", schemas.WEATHER).collect()


def test_whole_batch_from_published_files(spark, folder, tmp_path, capsys):
    from mercato.__main__ import main

    code = main(["--raw", folder, "--out", str(tmp_path / "out"), "--run-time", "2024-01-01T00:00:00", "--no-raise", "--database", "raw_files_test"])
    spark.sql("DROP DATABASE IF EXISTS raw_files_test CASCADE")
    assert code == 0 and '"status": "ok"' in capsys.readouterr().out
