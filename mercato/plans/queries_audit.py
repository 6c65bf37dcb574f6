"""Profiling, audit and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import enrich, file_audit, marts, profile, quality
from mercato.plans.oracle import R, with_ctes
from mercato.plans.queries_core import ofull, out, src, stg
from mercato.plans.registry import ORACLE, query
from mercato.plans.session import scratch_path
from mercato.sources import fixtures

# Expected output schema of the registered orders_full query (Spark type names).
ORDERS_FULL_TYPES = [
    ("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"),
    ("order_purchase_timestamp", "timestamp_ntz"), ("order_delivered_customer_date", "timestamp_ntz"),
    ("order_estimated_delivery_date", "timestamp_ntz"), ("purchase_date", "date"), ("delivery_date", "date"),
    ("estimated_date", "date"), ("delivery_days", "int"), ("was_late", "int"), ("year", "int"),
    ("month", "int"), ("customer_state", "string"), ("customer_city", "string"),
    ("total_payment", "double"), ("payment_count", "bigint"), ("item_count", "bigint"),
    ("items_total", "double"), ("freight_total", "double"), ("temp_max", "double"),
    ("precipitation", "double"), ("rain_category", "string"),
]
NUMERIC_SPARK = {"bigint", "int", "double", "smallint", "tinyint", "float"}

# Numeric columns of the driver's raw tables (for the cross-table audits).
RAW_NUMERIC = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax"],
    "events": ["event_id", "user_id", "value"],
    "documents": ["doc_id", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn"],
}
RAW_TABLES = list(RAW_NUMERIC)

# Numeric columns of the four loaded tables.
LOADED_NUMERIC = {
    "orders_full": [c for c, t in ORDERS_FULL_TYPES if t in NUMERIC_SPARK],
    "monthly_revenue": ["year", "month", "total_orders", "total_revenue", "avg_order_value",
                        "avg_delivery_days", "late_deliveries"],
    "revenue_by_state": ["total_orders", "total_revenue", "avg_order_value", "avg_delivery_days"],
    "weather_impact": ["total_orders", "avg_order_value"],
}
LOADED_CTE = {"orders_full": "ofull_out", "monthly_revenue": "etl_monthly",
              "revenue_by_state": "etl_state", "weather_impact": "etl_weather"}


def _dsum(col: str) -> str:
    return f"COALESCE(SUM(CAST({col} AS DECIMAL(38,6))), 0)"


def loaded_tables(spark, sf):
    full = ofull(spark, sf)
    return {
        "orders_full": out(full),
        "monthly_revenue": marts.monthly_revenue(full),
        "revenue_by_state": marts.revenue_by_state(full),
        "weather_impact": marts.weather_impact(full),
    }


def raw_tables(spark, sf):
    return {t: fixtures.read_table(spark, sf, t) for t in RAW_TABLES}


def dq_tables(spark, sf):
    full = ofull(spark, sf)
    s = enrich.stg_orders(full)
    return {
        "orders_full": full,
        "stg_orders": s,
        "stg_weather": enrich.stg_weather(full),
        # the checks read period / totals only: no median branch
        "monthly_revenue": marts.monthly_revenue_mart(s, with_median=False),
        "revenue_by_state": marts.revenue_by_state_mart(s, with_median=False),
        "weather_impact": marts.weather_impact_mart(s),
    }


DQ_CTE = {"orders_full": "ofull", "stg_orders": "stg", "stg_weather": "stg_weather_v",
          "monthly_revenue": "mart_monthly", "revenue_by_state": "mart_state", "weather_impact": "mart_weather"}

# ------------------------------------------------------------------ §2.10 profiling


def _profile_sql():
    parts = []
    for i, (c, t) in enumerate(ORDERS_FULL_TYPES):
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
            f"CAST(COUNT_IF({miss}) AS BIGINT) AS null_count, "
            f"{R(f'CAST(COUNT_IF({miss}) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0)', 1)} AS null_pct, "
            f"COUNT(*) AS n_rows, {len(ORDERS_FULL_TYPES)} AS n_cols FROM ofull_out"
        )
    return with_ctes("\nUNION ALL\n".join(parts))


@query("table_profile", _profile_sql())
def q_table_profile(spark, sf):
    return profile.table_profile(out(ofull(spark, sf)))


# Keys of the tables, by which sample rows are picked.
TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
    "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
    "orders_full": ["order_id"], "monthly_revenue": ["year", "month"], "revenue_by_state": ["customer_state"],
    "weather_impact": ["rain_category"],
}


def _columns_of(table: str) -> list[tuple[str, str]]:
    """(column, Spark type) of the given and the loaded tables, in order."""
    if table == "orders_full":
        return ORDERS_FULL_TYPES
    if table in _LOADED_TYPES:
        return _LOADED_TYPES[table]
    return [(c.split()[0], c.split()[1]) for c in fixtures.TABLE_SCHEMAS[table].split(", ")]


_LOADED_TYPES = {
    "monthly_revenue": [("year", "int"), ("month", "int"), ("total_orders", "bigint"), ("total_revenue", "double"),
                        ("avg_order_value", "double"), ("avg_delivery_days", "double"), ("late_deliveries", "bigint")],
    "revenue_by_state": [("customer_state", "string"), ("total_orders", "bigint"), ("total_revenue", "double"),
                         ("avg_order_value", "double"), ("avg_delivery_days", "double")],
    "weather_impact": [("rain_category", "string"), ("total_orders", "bigint"), ("avg_order_value", "double")],
}


def _tables_profile_sql() -> str:
    parts = []
    for table, key in TABLE_KEYS.items():
        relation, columns = LOADED_CTE.get(table, table), _columns_of(table)
        text = "concat_ws('/', " + ", ".join(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in key) + ")"
        sample = (
            f"(SELECT string_agg(k, ',' ORDER BY part) FROM (SELECT CASE WHEN d < '55555555' THEN 0 WHEN d < 'aaaaaaaa' THEN 1 ELSE 2 END AS part, "
            f"arg_min(k, d) AS k FROM (SELECT {text} AS k, md5({text}) AS d FROM {relation}) GROUP BY 1))"
        )
        for i, (c, t) in enumerate(columns):
            miss = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
            total = f"CAST({_dsum(c)} AS DOUBLE)" if t in NUMERIC_SPARK else "CAST(NULL AS DOUBLE)"
            parts.append(
                f"SELECT '{table}' AS table_name, {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
                f"CAST(COUNT_IF({miss}) AS BIGINT) AS null_count, "
                f"{R(f'CAST(COUNT_IF({miss}) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0)', 1)} AS null_pct, {total} AS total, "
                f"COUNT(*) AS n_rows, {len(columns)} AS n_cols, {sample} AS sample_keys FROM {relation}"
            )
    return with_ctes("\nUNION ALL\n".join(parts))


@query("tables_profile", _tables_profile_sql())
def q_tables_profile(spark, sf):
    """Columns, nulls, sums, rows and sample rows (here by their keys) of every
    given and every loaded table, each read once."""
    found = profile.profile_tables(raw_tables(spark, sf) | loaded_tables(spark, sf), TABLE_KEYS)

    def key_of(columns):
        return lambda row: F.concat_ws("/", *[F.coalesce(F.get_json_object(row, f"$.{c}"), F.lit("")) for c in columns])

    keys = F.lit(None).cast("string")
    for table, key in TABLE_KEYS.items():
        keys = F.when(F.col("table_name") == table, F.array_join(F.transform("sample_rows", key_of(key)), ",")).otherwise(keys)
    return found.withColumn("sample_keys", keys).drop("sample_rows")


@query(
    "numeric_sums",
    with_ctes("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({_dsum(c)} AS DOUBLE) AS total FROM ofull_out"
        for c in LOADED_NUMERIC["orders_full"]
    )),
)
def q_numeric_sums(spark, sf):
    return profile.numeric_sums(out(ofull(spark, sf)))


def _per_table_sums(tables: dict, cte_of, label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS {label}, {_dsum(c)} AS total FROM {cte_of(t)}"
        for t, cols in tables.items() for c in cols
    )


@query(
    "grand_numeric_totals",
    with_ctes(
        "SELECT column_name, CAST(SUM(total) AS DOUBLE) AS grand_total, COUNT(*) AS n_tables FROM ("
        + _per_table_sums(LOADED_NUMERIC, LOADED_CTE.get, "table_name")
        + ") p GROUP BY column_name"
    ),
)
def q_grand_numeric_totals(spark, sf):
    return profile.grand_numeric_totals(loaded_tables(spark, sf))


@query(
    "union_table_totals",
    with_ctes(
        "SELECT table_name, column_name, CAST(total AS DOUBLE) AS total FROM ("
        + _per_table_sums(LOADED_NUMERIC, LOADED_CTE.get, "table_name")
        + ") p"
    ),
)
def q_union_table_totals(spark, sf):
    return profile.union_table_totals(loaded_tables(spark, sf))


_RAW_SUMS = _per_table_sums(RAW_NUMERIC, lambda t: t, "source")


@query(
    "cross_file_totals",
    "SELECT column_name, source, CAST(total AS DOUBLE) AS total FROM (" + _RAW_SUMS + ") p\n"
    "UNION ALL\nSELECT column_name, NULL AS source, CAST(SUM(total) AS DOUBLE) AS total FROM ("
    + _RAW_SUMS + ") q GROUP BY column_name",
)
def q_cross_file_totals(spark, sf):
    return profile.cross_file_totals(raw_tables(spark, sf))


_CSV_SOURCES = {
    "customers": ("src_customers", ["customer_id", "customer_state"]),
    "payments": ("src_payments", ["order_id", "payment_sequential", "payment_value"]),
    "weather": ("src_weather", ["temp_max", "precipitation"]),
}
_CSV_SUMS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{f}' AS source, {_dsum(c)} AS total FROM {t}" for f, (t, cols) in _CSV_SOURCES.items() for c in cols
)
_CSV_ROWS = "\nUNION ALL\n".join(f"SELECT '{f}' AS source, COUNT(*) AS n FROM {t}" for f, (t, _) in _CSV_SOURCES.items())


@query(
    "audit_csv_files",
    with_ctes(
        "SELECT column_name, source, CAST(total AS DOUBLE) AS total, CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS VARCHAR) AS error "
        f"FROM ({_CSV_SUMS}) a\nUNION ALL\n"
        f"SELECT column_name, NULL, CAST(SUM(total) AS DOUBLE), NULL, NULL FROM ({_CSV_SUMS}) b GROUP BY column_name\nUNION ALL\n"
        f"SELECT NULL, source, NULL, n, NULL FROM ({_CSV_ROWS}) c\nUNION ALL\n"
        f"SELECT NULL, NULL, NULL, CAST(SUM(n) AS BIGINT), NULL FROM ({_CSV_ROWS}) d\nUNION ALL\n"
        "SELECT NULL, 'broken', NULL, NULL, CAST(COUNT(*) AS VARCHAR) || ' lines have more fields than the header' FROM src_customers"
    ),
)
def q_audit_csv_files(spark, sf):
    """Raw tables landed as CSV, and one whose lines are too long, audited file by file."""
    s, folder = src(spark, sf), scratch_path(spark, "csv-files")
    tables = {
        "customers": s.customers.select("customer_id", "customer_state", "customer_city"),
        "payments": s.payments.select("order_id", "payment_sequential", "payment_value"),
        "weather": enrich.clean_weather(s.weather),
        "broken": s.customers.select("customer_id", F.concat("customer_state", F.lit(",and,more")).alias("customer_state")),
    }
    for name, df in tables.items():
        df.write.option("header", True).option("quote", "").csv(f"{folder}/{name}")
    return file_audit.audit_csv_folder(spark, folder, by_folder=True)


@query(
    "row_counts",
    "SELECT table_name, n_rows FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in RAW_TABLES
    ) + ") p\nUNION ALL\nSELECT NULL, CAST(" + " + ".join(f"(SELECT COUNT(*) FROM {t})" for t in RAW_TABLES)
    + " AS BIGINT)",
)
def q_row_counts(spark, sf):
    return profile.row_counts(raw_tables(spark, sf))


@query(
    "describe_schema",
    "SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name, "
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' "
    "WHEN 'FLOAT' THEN 'float' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END AS data_type, is_nullable = 'YES' AS nullable "
    "FROM information_schema.columns WHERE table_name IN ("
    + ", ".join(f"'{t}'" for t in RAW_TABLES) + ")",
)
def q_describe_schema(spark, sf):
    return profile.describe_schema({t: spark.read.parquet(f"{sf}/{t}.parquet") for t in RAW_TABLES})


@query("sample_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 3")
def q_sample_rows(spark, sf):
    return profile.sample_rows(fixtures.read_table(spark, sf, "customer"), 3, "c_custkey")


# ------------------------------------------------------------------ §2.11 data quality

_V = "CAST({k} AS VARCHAR) AS row_key"


@query(
    "dq_not_null",
    with_ctes("\nUNION ALL\n".join(
        f"SELECT 'not_null' AS \"check\", '{t}' AS table_name, '{c}' AS column_name, "
        f"{_V.format(k=k)}, CAST(NULL AS VARCHAR) AS bad_value FROM {DQ_CTE[t]} WHERE {c} IS NULL"
        for t, k, c in quality.NOT_NULL_CHECKS
    )),
)
def q_dq_not_null(spark, sf):
    return quality.dq_not_null(dq_tables(spark, sf))


@query(
    "dq_unique",
    with_ctes("\nUNION ALL\n".join(
        f"SELECT 'unique' AS \"check\", '{t}' AS table_name, '{c}' AS column_name, "
        f"{_V.format(k=c)}, CAST(COUNT(*) AS VARCHAR) AS bad_value FROM {DQ_CTE[t]} "
        f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
        for t, c in quality.UNIQUE_CHECKS
    )),
)
def q_dq_unique(spark, sf):
    return quality.dq_unique(dq_tables(spark, sf))


def _accepted_sql(values):
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


@query(
    "dq_accepted_values",
    with_ctes("\nUNION ALL\n".join(
        f"SELECT 'accepted_values' AS \"check\", '{t}' AS table_name, '{c}' AS column_name, "
        f"{_V.format(k=k)}, CAST({c} AS VARCHAR) AS bad_value FROM {DQ_CTE[t]} "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN ({_accepted_sql(v)})"
        for t, k, c, v in quality.ACCEPTED_VALUES_CHECKS
    )),
)
def q_dq_accepted_values(spark, sf):
    return quality.dq_accepted_values(dq_tables(spark, sf))


@query("dq_report", "\nUNION ALL\n".join(f"SELECT * FROM ({ORACLE[k]}) {k}" for k in ("dq_not_null", "dq_unique", "dq_accepted_values")))
def q_dq_report(spark, sf):
    """The three kinds of checks at once: every table is read once."""
    return quality.dq_report(dq_tables(spark, sf))


# orders_full with violations of every rule: (column, modulus of order_id, value)
SEEDED = [("total_payment", 97, None), ("customer_state", 101, None), ("was_late", 89, 7), ("rain_category", 83, "Snow")]
SEEDED_TWICE = 31
_SEEDED_SQL = with_ctes(
    "SELECT order_id, customer_id, " + ", ".join(
        f"CASE WHEN order_id % {n} = 0 THEN {'NULL' if v is None else repr(v)} ELSE {c} END AS {c}" for c, n, v in SEEDED
    ) + f" FROM ofull, (VALUES (1), (2)) AS copies(k) WHERE k = 1 OR order_id % {SEEDED_TWICE} = 0"
)


def seeded(spark, sf):
    full, order_id = ofull(spark, sf).select("order_id", "customer_id", *[c for c, _, _ in SEEDED]), F.col("order_id")
    damaged = full.withColumns({c: F.when(order_id % n == 0, F.lit(v)).otherwise(F.col(c)) for c, n, v in SEEDED})
    copies = F.when(order_id % SEEDED_TWICE == 0, 2).otherwise(1)
    return damaged.select("*", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


@query(
    "dq_seeded",
    "\nUNION ALL\n".join(
        [f"SELECT 'not_null' AS \"check\", 'orders_full' AS table_name, '{c}' AS column_name, {_V.format(k='order_id')}, "
         f"CAST(NULL AS VARCHAR) AS bad_value FROM ({_SEEDED_SQL}) s WHERE {c} IS NULL"
         for t, _, c in quality.NOT_NULL_CHECKS if t == "orders_full"]
        + [f"SELECT 'accepted_values', 'orders_full', '{c}', {_V.format(k='order_id')}, CAST({c} AS VARCHAR) FROM ({_SEEDED_SQL}) s "
           f"WHERE {c} IS NOT NULL AND {c} NOT IN ({_accepted_sql(v)})"
           for t, _, c, v in quality.ACCEPTED_VALUES_CHECKS if t == "orders_full"]
        + [f"SELECT 'unique', 'orders_full', '{c}', CAST({c} AS VARCHAR), CAST(COUNT(*) AS VARCHAR) FROM ({_SEEDED_SQL}) s "
           f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
           for t, c in [*quality.UNIQUE_CHECKS, ("orders_full", "customer_id")] if t == "orders_full"]
    ),
)
def q_dq_seeded(spark, sf):
    """The checks of orders_full on a copy with violations of every one."""
    mine = lambda checks: [c for c in checks if c[0] == "orders_full"]
    return quality.dq_report(
        {"orders_full": seeded(spark, sf)},
        mine(quality.NOT_NULL_CHECKS),
        [*mine(quality.UNIQUE_CHECKS), ("orders_full", "customer_id")],
        mine(quality.ACCEPTED_VALUES_CHECKS),
    )


@query("dq_positive_revenue", with_ctes("SELECT period, total_revenue FROM mart_monthly WHERE total_revenue <= 0"))
def q_dq_positive_revenue(spark, sf):
    return quality.dq_positive_revenue(marts.monthly_revenue_mart(stg(spark, sf), with_median=False))


@query(
    "dq_late_rate_range",
    with_ctes("SELECT customer_state, late_rate_pct FROM mart_state WHERE late_rate_pct < 0 OR late_rate_pct > 50"),
)
def q_dq_late_rate_range(spark, sf):
    return quality.dq_late_rate_range(marts.revenue_by_state_mart(stg(spark, sf), with_median=False))


TOP_STATE = "0"


@query(
    "dq_top_state",
    with_ctes(
        f"SELECT customer_state, revenue_rank FROM mart_state WHERE customer_state = '{TOP_STATE}' "
        "AND revenue_rank != 1"
    ),
)
def q_dq_top_state(spark, sf):
    return quality.dq_top_state(marts.revenue_by_state_mart(stg(spark, sf), with_median=False), TOP_STATE)


@query(
    "dq_row_counts",
    with_ctes(
        "SELECT table_name, has_rows FROM (" + "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS has_rows FROM (SELECT 1 FROM {cte} LIMIT 1) x"
            for t, cte in LOADED_CTE.items()
        ) + ") p WHERE has_rows = 0"
    ),
)
def q_dq_row_counts(spark, sf):
    return quality.dq_row_counts(loaded_tables(spark, sf))


@query(
    "dq_null_counts",
    with_ctes(
        "SELECT column_name, null_count FROM (" + "\nUNION ALL\n".join(
            f"SELECT '{alias}' AS column_name, CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS null_count FROM ofull"
            for c, alias in quality.NULL_COUNT_COLUMNS
        ) + ") p WHERE null_count > 0"
    ),
)
def q_dq_null_counts(spark, sf):
    return quality.dq_null_counts(ofull(spark, sf))
