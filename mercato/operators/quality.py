"""Data-quality checks. Each check returns the *violating rows*; a check
passes when it returns none.

Generic checks share one schema so they can be unioned and counted:
(check, table_name, column_name, row_key, bad_value) — all text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import rules
from mercato.operators import rule_pass

VIOLATION_COLUMNS = ["check", "table_name", "column_name", "row_key", "bad_value"]

# Checks on the enriched table, the staging views and the marts.
# (table, key column, column)
NOT_NULL_CHECKS = [
    ("orders_full", "order_id", "order_id"),
    ("orders_full", "order_id", "customer_id"),
    ("orders_full", "order_id", "total_payment"),
    ("orders_full", "order_id", "customer_state"),
    ("stg_orders", "order_id", "order_id"),
    ("stg_orders", "order_id", "total_payment"),
    ("stg_weather", "weather_date", "weather_date"),
    ("monthly_revenue", "period", "period"),
    ("monthly_revenue", "period", "total_orders"),
    ("monthly_revenue", "period", "total_revenue"),
    ("revenue_by_state", "customer_state", "customer_state"),
    ("revenue_by_state", "customer_state", "total_revenue"),
    ("weather_impact", "rain_category", "rain_category"),
]
UNIQUE_CHECKS = [
    ("orders_full", "order_id"),
    ("stg_orders", "order_id"),
    ("stg_weather", "weather_date"),
    ("monthly_revenue", "period"),
    ("revenue_by_state", "customer_state"),
    ("weather_impact", "rain_category"),
]
ACCEPTED_VALUES_CHECKS = [
    ("orders_full", "order_id", "was_late", [0, 1]),
    ("orders_full", "order_id", "rain_category", rules.RAIN_CATEGORIES),
    ("stg_orders", "order_id", "was_late", [0, 1]),
    ("stg_orders", "order_id", "rain_category", rules.RAIN_CATEGORIES),
    ("stg_weather", "weather_date", "temp_category", rules.TEMP_CATEGORIES),
]
LATE_RATE_MAX_PCT = 50
NULL_COUNT_COLUMNS = [("order_id", "null_order_ids"), ("total_payment", "null_payments"), ("customer_state", "null_states")]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _by_table(not_null=(), accepted=(), unique=()) -> dict[str, list[rule_pass.TableRules]]:
    """Rules of each table, one set a row key. Checks: (table, key, column[, values])
    and (table, column)."""
    grouped: dict[tuple[str, str | None], dict] = {}
    for t, k, c in not_null:
        grouped.setdefault((t, k), {}).setdefault("not_null", []).append(c)
    for t, k, c, values in accepted:
        grouped.setdefault((t, k), {}).setdefault("accepted", {})[c] = values
    for t, c in unique:
        key = next((k for name, k in grouped if name == t), None)
        grouped.setdefault((t, key), {}).setdefault("unique", []).append(c)
    out: dict[str, list] = {}
    for (t, k), rules in grouped.items():
        out.setdefault(t, []).append(rule_pass.TableRules(k, **rules))
    return out


def _report(tables: Mapping[str, DataFrame], rules: dict[str, list[rule_pass.TableRules]]) -> DataFrame:
    return _union([rule_pass.violations(tables[t], t, r) for t, several in rules.items() for r in several])


def dq_not_null(tables: Mapping[str, DataFrame], checks=NOT_NULL_CHECKS) -> DataFrame:
    return _report(tables, _by_table(not_null=checks))


def dq_unique(tables: Mapping[str, DataFrame], checks=UNIQUE_CHECKS) -> DataFrame:
    """Values that occur more than once (NULLs ignored)."""
    return _report(tables, _by_table(unique=checks))


def dq_accepted_values(tables: Mapping[str, DataFrame], checks=ACCEPTED_VALUES_CHECKS) -> DataFrame:
    """Non-NULL values outside the accepted list."""
    return _report(tables, _by_table(accepted=checks))


def dq_report(
    tables: Mapping[str, DataFrame], not_null=NOT_NULL_CHECKS, unique=UNIQUE_CHECKS, accepted=ACCEPTED_VALUES_CHECKS
) -> DataFrame:
    """The three kinds of checks of all tables at once: one pass a table."""
    return _report(tables, _by_table(not_null, accepted, unique))


def dq_positive_revenue(monthly_mart: DataFrame) -> DataFrame:
    return monthly_mart.where(F.col("total_revenue") <= 0).select("period", "total_revenue")


def dq_late_rate_range(state_mart: DataFrame, max_pct: float = LATE_RATE_MAX_PCT) -> DataFrame:
    r = F.col("late_rate_pct")
    return state_mart.where((r < 0) | (r > max_pct)).select("customer_state", "late_rate_pct")


def dq_top_state(state_mart: DataFrame, state: str) -> DataFrame:
    """The named state must rank first; passes when the state is absent."""
    return state_mart.where((F.col("customer_state") == state) & (F.col("revenue_rank") != 1)).select(
        "customer_state", "revenue_rank"
    )


def dq_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables without rows: (table_name, has_rows = 0). Reads at most one row
    per table."""
    return _union([
        t.limit(1).agg(F.count(F.lit(1)).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")
        for name, t in tables.items()
    ]).where(F.col("has_rows") == 0)


def null_counts(orders_full: DataFrame) -> DataFrame:
    """One row: NULL counts of the critical columns (0, not NULL, when empty)."""
    return orders_full.agg(*[
        F.coalesce(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)), F.lit(0)).cast("long").alias(alias)
        for c, alias in NULL_COUNT_COLUMNS
    ])


def dq_null_counts(orders_full: DataFrame) -> DataFrame:
    """(column_name, null_count) for critical columns with NULLs."""
    names = [a for _, a in NULL_COUNT_COLUMNS]
    return (
        null_counts(orders_full)
        .select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("null_count")) for n in names])))
        .where(F.col("null_count") > 0)
    )


class DataQualityError(ValueError):
    """Raised by :func:`run_checks` with the list of failed checks."""

    def __init__(self, failures: list[str]):
        super().__init__("data quality validation failed: " + "; ".join(failures))
        self.failures = failures


class CheckCounts(dict):
    """Violating rows by check, -1 for a check whose query failed; ``errors``
    has those queries' messages."""

    def __init__(self) -> None:
        super().__init__()
        self.errors: dict[str, str] = {}

    @property
    def failures(self) -> list[str]:
        return [
            f"{n}: query error: {self.errors.get(n, '')}" if c < 0 else f"{n}: {c} violating rows"
            for n, c in self.items()
            if c
        ]


def run_checks(checks: Mapping[str, DataFrame], raise_on_failure: bool = True, parallel: int = 4) -> CheckCounts:
    """Count violating rows per check (one small aggregate each); a check
    whose query fails counts as failed, not as a crash, and keeps its message. Up to ``parallel``
    checks are submitted at once from driver threads, so the scheduler can
    overlap their jobs. Raises :class:`DataQualityError` listing every
    failure."""
    from concurrent.futures import ThreadPoolExecutor

    results = CheckCounts()

    def count(name: str) -> int:
        try:
            return checks[name].count()
        except Exception as exc:  # noqa: BLE001 - a failing query is a failed check
            results.errors[name] = str(exc).split("\n")[0][:300]
            return -1

    names = list(checks)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results.update(zip(names, pool.map(count, names)))
    if results.failures and raise_on_failure:
        raise DataQualityError(results.failures)
    return results
