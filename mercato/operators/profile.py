"""Table profiling and audits, one pass per table.

Where the reference pulled whole tables into one process to loop over
columns, each profile here is a single distributed aggregate (partial per
task) whose one-row result is unpivoted with ``inline``. A numeric sum has two
parts: DECIMAL(38,6), exact whatever the row order, and the digits beyond the
sixth as double (exactly 0 where there are none), so small values are not lost.
NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
SUM_TYPE = T.DecimalType(38, 6)


def _q(name: str):
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans, dates and timestamps excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, null count (NaN counts as null), null % (NULL when the
    table is empty), table rows and column count."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        missing = _q(f.name).isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(_q(f.name))
        aggs.append(F.count_if(missing).alias(f"_n{i}"))
    per_col = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, f in enumerate(fields)
    ])
    return (
        df.agg(*aggs)
        .select(F.col("_rows").alias("n_rows"), F.inline(per_col))
        .select(
            "position", "column_name", "data_type", "null_count",
            F.round(F.try_divide(F.col("null_count") * F.lit(100.0), F.col("n_rows")), 1).alias("null_pct"),
            "n_rows",
            F.lit(len(fields)).alias("n_cols"),
        )
    )


def _sum_parts(df: DataFrame) -> DataFrame:
    """(column_name, total, rest) of every numeric column."""
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, total decimal(38,6), rest double")
    aggs = []
    for i, c in enumerate(cols):
        v, rest = _q(c), F.lit(0.0)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            v = F.nanvl(v.cast("double"), F.lit(None).cast("double"))
            # beyond 1e31 a double does not fit the decimal; such a value is all rest
            head = F.when(F.abs(v) < 1e31, v).cast(SUM_TYPE)
            rest = F.coalesce(F.sum(v - F.coalesce(head.cast("double"), F.lit(0.0))), F.lit(0.0))
            v = head
        aggs += [F.coalesce(F.sum(v.cast(SUM_TYPE)), F.lit(0).cast(SUM_TYPE)).alias(f"_s{i}"), rest.alias(f"_r{i}")]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("total"), F.col(f"_r{i}").alias("rest"))
        for i, c in enumerate(cols)
    ])))


def _total():
    """The two parts, summed, as double."""
    return F.sum("total").cast("double") + F.sum("rest")


def numeric_sums(df: DataFrame) -> DataFrame:
    """(column_name, total): SUM of every numeric column; an empty or all-NULL
    column sums to 0."""
    return _sum_parts(df).select("column_name", (F.col("total").cast("double") + F.col("rest")).alias("total"))


#: Sample rows of a table in ``profile_tables``.
SAMPLED = 3


def _sampled(df: DataFrame, key: Sequence[str]) -> list:
    """One aggregate for each of SAMPLED parts of the key's hash range: the row
    of the least hash there. They merge like any minimum, so a sample costs no
    second scan and is the same however the rows are dealt."""
    digest = F.md5(F.concat_ws("/", *[F.coalesce(_q(k).cast("string"), F.lit("")) for k in key]))
    bounds = [f"{k * (1 << 32) // SAMPLED:08x}" for k in range(SAMPLED)] + ["g"]
    row = F.struct(digest.alias("digest"), F.struct(*[_q(c) for c in df.columns]).alias("row"))  # the row itself settles ties
    return [F.min(F.when((digest >= lo) & (digest < hi), row)) for lo, hi in zip(bounds, bounds[1:])]


def profile_tables(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every table in one pass each. Per table and column: position, data_type,
    null_count (NaN is null), null_pct (null if there are no rows), total (the
    sum; null if not numeric), n_rows and n_cols of the table, and sample_rows
    (up to SAMPLED rows as JSON, picked by their ``keys``)."""
    return _union_all([_profiled(name, df, keys[name]) for name, df in tables.items()])


def _profiled(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [least.alias(f"_k{i}") for i, least in enumerate(_sampled(df, key))]
    totals = []
    for i, f in enumerate(fields):
        value, missing, rest = _q(f.name), _q(f.name).isNull(), F.lit(0.0)
        total = F.lit(None).cast("double")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(value)
            value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            head = F.when(F.abs(value) < 1e31, value).cast(SUM_TYPE)
            rest = F.coalesce(F.sum(value - F.coalesce(head.cast("double"), F.lit(0.0))), F.lit(0.0))
            value = head
        if isinstance(f.dataType, NUMERIC_TYPES):
            aggs += [F.coalesce(F.sum(value.cast(SUM_TYPE)), F.lit(0).cast(SUM_TYPE)).alias(f"_s{i}"), rest.alias(f"_r{i}")]
            total = F.col(f"_s{i}").cast("double") + F.col(f"_r{i}")
        aggs.append(F.count_if(missing).alias(f"_n{i}"))
        totals.append(total)
    per_column = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("null_count"), totals[i].alias("total"),
        )
        for i, f in enumerate(fields)
    ])
    sample = F.transform(F.array_compact(F.array(*[F.col(f"_k{i}") for i in range(SAMPLED)])), lambda s: F.to_json(s["row"]))
    return df.agg(*aggs).select(F.col("_rows").alias("n_rows"), sample.alias("sample_rows"), F.inline(per_column)).select(
        F.lit(name).alias("table_name"), "position", "column_name", "data_type", "null_count",
        F.round(F.try_divide(F.col("null_count") * F.lit(100.0), F.col("n_rows")), 1).alias("null_pct"),
        "total", "n_rows", F.lit(len(fields)).alias("n_cols"), "sample_rows",
    )


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_table_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, total): per-table numeric sums, unioned (one
    partial aggregate per table)."""
    return _union_all([
        numeric_sums(df).select(F.lit(name).alias("table_name"), "column_name", "total") for name, df in tables.items()
    ])


def grand_numeric_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(column_name, grand_total, n_tables): sums by column name across tables."""
    per = _union_all([_sum_parts(df) for df in tables.values()])
    return per.groupBy("column_name").agg(
        _total().alias("grand_total"),
        F.count(F.lit(1)).alias("n_tables"),
    )


def cross_file_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(column_name, source, total): per column, one row per source plus an
    overall row (source NULL), via ROLLUP."""
    per = _union_all([_sum_parts(df).withColumn("source", F.lit(name)) for name, df in tables.items()])
    return (
        per.rollup("column_name", "source")
        .agg(_total().alias("total"))
        .where(F.col("column_name").isNotNull())
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) per table plus the total (table_name NULL)."""
    per = _union_all([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ])
    return per.rollup("table_name").agg(F.sum("n_rows").cast("long").alias("n_rows"))


def describe_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, data_type, nullable) of every table,
    from the schemas the files carry (metadata only)."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean"
    )


def sample_rows(df: DataFrame, n: int = 3, key: str | Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in key order (all columns when no key) — deterministic."""
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    return df.orderBy(*[_q(k) for k in keys]).limit(n)
