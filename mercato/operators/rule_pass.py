"""All data-quality rules of one table in one pass over it.

Row rules (not null, accepted values) and uniqueness rules are compiled into one
generator over one scan: each row yields a candidate for every rule it breaks,
and for every uniqueness rule its value. Row rules end there. With uniqueness
rules one grouped pass over (rule, value) follows for all of them; it counts
partially in each task, so a hot value costs one row a task, and never lists the
rows of a value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class TableRules:
    """Rules of a table. ``key`` is the column that names a row in reports."""

    key: str | None = None
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Iterable] = field(default_factory=dict)
    unique: Sequence[str] = ()


def _candidate(check: str, column: str, key: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(column).alias("column_name"),
        key.cast("string").alias("row_key"), bad.cast("string").alias("bad_value"),
    )


def _value(df: DataFrame, column: str) -> Column:
    """The value as text, equal texts for equal values (-0.0 is 0.0)."""
    value = F.col(column)
    return value + F.lit(0.0) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else value


def violations(df: DataFrame, table: str, rules: TableRules) -> DataFrame:
    """(check, table_name, column_name, row_key, bad_value), all text: a row per
    broken row rule (``row_key`` of the row, the value not accepted), and a row per
    value that is not unique (``row_key`` the value, ``bad_value`` its rows). Null
    values break not_null alone."""
    key, none = F.col(rules.key) if rules.key else F.lit(None), F.lit(None)
    candidates = [F.when(F.col(c).isNull(), _candidate(NOT_NULL, c, key, none)) for c in rules.not_null]
    candidates += [
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(values)), _candidate(ACCEPTED, c, key, F.col(c)))
        for c, values in rules.accepted.items()
    ]
    candidates += [F.when(F.col(c).isNotNull(), _candidate(UNIQUE, c, _value(df, c), none)) for c in rules.unique]
    if not candidates:
        raise ValueError(f"no rules for {table}")
    found = df.select(F.inline(F.filter(F.array(*candidates), lambda c: c.isNotNull())))
    if rules.unique:
        grouped = found.groupBy("check", "column_name", "row_key", "bad_value").agg(F.count(F.lit(1)).alias("n"))
        is_unique = F.col("check") == UNIQUE
        times = F.when(is_unique, 1).otherwise(F.col("n"))
        found = (
            grouped.filter(~is_unique | (F.col("n") > 1))
            .withColumn("bad_value", F.when(is_unique, F.col("n").cast("string")).otherwise(F.col("bad_value")))
            .select("check", "column_name", "row_key", "bad_value", F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))))
        )
    return found.select("check", F.lit(table).alias("table_name"), "column_name", "row_key", "bad_value")


def report(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """Violations of all tables, each read once."""
    parts = [violations(tables[name], name, r) for name, r in rules.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
