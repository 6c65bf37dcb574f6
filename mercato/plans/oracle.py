"""Independent SQL twin of every registered query (DuckDB dialect).

The CTEs below restate the fixture adapter and the enrichment in plain SQL;
each oracle query is ``WITH <all CTEs> <final SELECT>``. Unreferenced CTEs
are ignored by DuckDB.

Numeric conventions shared with the Spark side (SURVEY §7.4):
  * money is DECIMAL(18,2); sums are exact, cast to DOUBLE
  * averages are CAST(SUM(x) AS DOUBLE) / COUNT(x)
  * ROUND of a double is HALF_UP on its shortest decimal text (Spark's rule),
    written here as R(x, s)
"""

from __future__ import annotations


def R(x: str, s: int) -> str:
    """Spark's ROUND(double, s) in DuckDB."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,12)), {s}) AS DOUBLE)"


def MSUM(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def MAVG(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def RAIN(p: str, null_policy: str = "heavy") -> str:
    if null_policy == "no_rain":
        p = f"COALESCE({p}, 0)"
    return (
        f"CASE WHEN {p} = 0 THEN 'No Rain' WHEN {p} < 5 THEN 'Light Rain' ELSE 'Heavy Rain' END"
    )


def TEMP(t: str) -> str:
    return f"CASE WHEN {t} >= 30 THEN 'Hot' WHEN {t} >= 22 THEN 'Warm' ELSE 'Cool' END"


def PERIOD(y: str = "year", m: str = "month") -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || LPAD(CAST({m} AS VARCHAR), 2, '0'))"


def RAIN_ORDER(c: str, unknown: int = 4, first: int = 1) -> str:
    return (
        f"CASE {c} WHEN 'No Rain' THEN {first} WHEN 'Light Rain' THEN {first + 1} "
        f"WHEN 'Heavy Rain' THEN {first + 2} ELSE {unknown} END"
    )


FREIGHT = "CAST(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(6,0)) AS DECIMAL(18,2))"

_CTES = {
    "src_orders": """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       CASE WHEN o.o_orderstatus = 'F' THEN 'delivered'
            WHEN o.o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       o.o_orderdate + to_days(m.lead_days) AS order_delivered_customer_date,
       o.o_orderdate + to_days(12 + 3 * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER))
           AS order_estimated_delivery_date
FROM orders o
LEFT JOIN (SELECT l_orderkey, CAST(MIN(l_quantity) AS INTEGER) AS lead_days
           FROM lineitem GROUP BY l_orderkey) m ON o.o_orderkey = m.l_orderkey""",
    "src_customers": """
SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS customer_state,
       c_mktsegment AS customer_city
FROM customer""",
    "src_payments": f"""
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + {FREIGHT} AS DECIMAL(18,2)) AS payment_value
FROM lineitem""",
    "src_items": f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price, {FREIGHT} AS freight_value
FROM lineitem""",
    "src_weather": """
SELECT CAST(l_shipdate AS DATE) AS "date",
       CAST(8 + SUM(l_partkey) % 30 AS DOUBLE) AS temp_max,
       CAST(GREATEST(0, SUM(l_linenumber) % 16 - 8) AS DOUBLE) AS precipitation
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
GROUP BY CAST(l_shipdate AS DATE)""",
    "src_states": """
SELECT CAST(n_nationkey AS VARCHAR) AS state_code, n_name AS state_name FROM nation""",
    "delivered": """
SELECT * FROM src_orders WHERE order_status = 'delivered'""",
    "clean": """
SELECT d.*, CAST(date_diff('day', purchase_date, delivery_date) AS INTEGER) AS delivery_days,
       CASE WHEN delivery_date > estimated_date THEN 1 ELSE 0 END AS was_late,
       CAST(year(purchase_date) AS INTEGER) AS year, CAST(month(purchase_date) AS INTEGER) AS month
FROM (SELECT *, CAST(order_purchase_timestamp AS DATE) AS purchase_date,
             CAST(order_delivered_customer_date AS DATE) AS delivery_date,
             CAST(order_estimated_delivery_date AS DATE) AS estimated_date
      FROM delivered) d""",
    "pay_agg": """
SELECT order_id, CAST(SUM(payment_value) AS DECIMAL(18,2)) AS total_payment,
       COUNT(payment_sequential) AS payment_count
FROM src_payments GROUP BY order_id""",
    "item_agg": """
SELECT order_id, COUNT(order_item_id) AS item_count,
       CAST(SUM(price) AS DECIMAL(18,2)) AS items_total,
       CAST(SUM(freight_value) AS DECIMAL(18,2)) AS freight_total
FROM src_items GROUP BY order_id""",
    "ofull": f"""
SELECT c.order_id, c.customer_id, c.order_status, c.order_purchase_timestamp,
       c.order_delivered_customer_date, c.order_estimated_delivery_date,
       c.purchase_date, c.delivery_date, c.estimated_date, c.delivery_days, c.was_late,
       c.year, c.month, cu.customer_state, cu.customer_city,
       p.total_payment, p.payment_count, i.item_count, i.items_total, i.freight_total,
       w.temp_max, w.precipitation, {RAIN('w.precipitation', 'no_rain')} AS rain_category
FROM clean c
LEFT JOIN src_customers cu ON c.customer_id = cu.customer_id
LEFT JOIN pay_agg p ON c.order_id = p.order_id
LEFT JOIN item_agg i ON c.order_id = i.order_id
LEFT JOIN src_weather w ON c.purchase_date = w."date\"""",
    "stg": f"""
SELECT order_id, customer_id, customer_state, customer_city,
       order_purchase_timestamp AS purchase_ts, order_delivered_customer_date AS delivered_ts,
       order_estimated_delivery_date AS estimated_ts, purchase_date, delivery_date, estimated_date,
       COALESCE(total_payment, 0) AS total_payment, COALESCE(delivery_days, 0) AS delivery_days,
       COALESCE(item_count, 0) AS item_count, COALESCE(items_total, 0) AS items_total,
       COALESCE(freight_total, 0) AS freight_total, was_late,
       CASE WHEN was_late = 1 THEN 'Late' ELSE 'On Time' END AS delivery_status,
       year, month, temp_max, COALESCE(precipitation, 0) AS precipitation, rain_category
FROM ofull
WHERE order_id IS NOT NULL AND total_payment IS NOT NULL AND total_payment > 0""",
    "etl_monthly": f"""
SELECT year, month, COUNT(order_id) AS total_orders,
       {R(MSUM('total_payment'), 2)} AS total_revenue,
       {R(MAVG('total_payment'), 2)} AS avg_order_value,
       {R(MAVG('delivery_days'), 1)} AS avg_delivery_days,
       CAST(SUM(was_late) AS BIGINT) AS late_deliveries
FROM ofull GROUP BY year, month""",
    "etl_state": f"""
SELECT customer_state, COUNT(order_id) AS total_orders,
       {R(MSUM('total_payment'), 2)} AS total_revenue,
       {R(MAVG('total_payment'), 2)} AS avg_order_value,
       {R(MAVG('delivery_days'), 1)} AS avg_delivery_days
FROM ofull GROUP BY customer_state""",
    "etl_weather": f"""
SELECT rain_category, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       {R(MAVG('CAST(avg_order_value AS DECIMAL(18,2))'), 2)} AS avg_order_value
FROM (SELECT {RAIN('precipitation')} AS rain_category, total_orders, avg_order_value
      FROM (SELECT precipitation, COUNT(order_id) AS total_orders,
                   {R(MAVG('total_payment'), 2)} AS avg_order_value
            FROM ofull GROUP BY precipitation) pv) b
GROUP BY rain_category""",
    "med_month": f"""
SELECT year, month, MEDIAN(CAST(total_payment * 100 AS BIGINT)) / 100 AS med
FROM stg GROUP BY year, month""",
    "med_state": f"""
SELECT customer_state, MEDIAN(CAST(total_payment * 100 AS BIGINT)) / 100 AS med
FROM stg WHERE customer_state IS NOT NULL GROUP BY customer_state""",
    "mart_monthly": f"""
SELECT a.year, a.month, {PERIOD('a.year', 'a.month')} AS period, total_orders, total_revenue,
       avg_order_value, {R('m.med', 2)} AS median_order_value, avg_delivery_days,
       late_deliveries, late_rate_pct, avg_items_per_order
FROM (SELECT year, month, COUNT(order_id) AS total_orders,
             {R(MSUM('total_payment'), 2)} AS total_revenue,
             {R(MAVG('total_payment'), 2)} AS avg_order_value,
             {R(MAVG('delivery_days'), 1)} AS avg_delivery_days,
             CAST(SUM(was_late) AS BIGINT) AS late_deliveries,
             {R('CAST(SUM(was_late) AS DOUBLE) * 100.0 / COUNT(order_id)', 2)} AS late_rate_pct,
             {R(MAVG('item_count'), 1)} AS avg_items_per_order
      FROM stg GROUP BY year, month) a
LEFT JOIN med_month m ON a.year IS NOT DISTINCT FROM m.year AND a.month IS NOT DISTINCT FROM m.month""",
    "mart_state": f"""
SELECT a.customer_state, total_orders, total_revenue, avg_order_value,
       {R('m.med', 2)} AS median_order_value, avg_delivery_days, late_deliveries, late_rate_pct,
       CAST(RANK() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank
FROM (SELECT customer_state, COUNT(order_id) AS total_orders,
             {R(MSUM('total_payment'), 2)} AS total_revenue,
             {R(MAVG('total_payment'), 2)} AS avg_order_value,
             {R(MAVG('delivery_days'), 1)} AS avg_delivery_days,
             CAST(SUM(was_late) AS BIGINT) AS late_deliveries,
             {R('CAST(SUM(was_late) AS DOUBLE) * 100.0 / COUNT(order_id)', 2)} AS late_rate_pct,
             SUM(total_payment) AS rev
      FROM stg WHERE customer_state IS NOT NULL GROUP BY customer_state) a
LEFT JOIN med_state m ON a.customer_state = m.customer_state""",
    "mart_weather": f"""
SELECT rain_category, COUNT(order_id) AS total_orders,
       {R(MAVG('total_payment'), 2)} AS avg_order_value,
       {R(MSUM('total_payment'), 2)} AS total_revenue,
       {R(MAVG('precipitation'), 2)} AS avg_precipitation_mm,
       {R(MAVG('temp_max'), 1)} AS avg_temp_max_c
FROM stg WHERE rain_category IS NOT NULL GROUP BY rain_category""",
}

OFULL_OUT = """order_id, customer_id, order_status, order_purchase_timestamp,
       order_delivered_customer_date, order_estimated_delivery_date, purchase_date, delivery_date,
       estimated_date, delivery_days, was_late, year, month, customer_state, customer_city,
       CAST(total_payment AS DOUBLE) AS total_payment, payment_count, item_count,
       CAST(items_total AS DOUBLE) AS items_total, CAST(freight_total AS DOUBLE) AS freight_total,
       temp_max, precipitation, rain_category"""

_CTES["ofull_out"] = f"SELECT {OFULL_OUT} FROM ofull"
_CTES["stg_weather_v"] = f"""
SELECT DISTINCT purchase_date AS weather_date, temp_max, precipitation, rain_category,
       {TEMP('temp_max')} AS temp_category
FROM ofull WHERE purchase_date IS NOT NULL"""


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in _CTES.items())
    return f"WITH {body}\n{select}"

