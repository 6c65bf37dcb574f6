"""Catalog tables that are replaced in one step.

Every version of a table is a table of its own, in a folder of its own, and the
table's name is a view on the current one. ``replace_table`` writes a new
version, counts its rows inside that job and reads the count back from the files'
footers; only then it points the view at the new version, which is one change in
the catalog, also where the columns differ. Until then readers see the old
version, whole, and a write that fails leaves it as it was. Versions before the
last KEPT are dropped, so a query that reads the one before can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources import io

#: Versions of a table that stay, the current one included.
KEPT = 2


def replace_table(
    df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = (), check: Callable[[], object] = lambda: None
) -> int:
    """Make ``df`` the contents of ``name`` (database.table), whose versions lie
    under ``folder``; returns its rows. ``check`` runs when the rows are written
    and may still refuse them by raising. A table of that name that is no view of
    versions is dropped first."""
    spark, folder = df.sparkSession, folder.rstrip("/")
    database, table = name.split(".")
    version = _fresh(_versions(spark, database, table))
    path, stored = f"{folder}/{version}", f"{database}.{table}__{version}"
    try:
        written = io.write_parquet(df, path, list(partition_by) or None)
        check()
        found = spark.read.schema(df.schema).parquet(path).agg(F.count(F.lit(1)).alias("n")).first()["n"]
        if found != written:
            raise OSError(f"{name}: {written} rows written, {found} found in {path}")
        spark.catalog.createTable(stored, path=path, source="parquet")
        if partition_by:
            spark.catalog.recoverPartitions(stored)
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {_quoted(name)}")
        columns = ", ".join(f"`{c}`" for c in df.columns)
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT {columns} FROM {_quoted(stored)}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(stored)}")
        _delete(spark, path)
        raise
    for old in _versions(spark, database, table)[:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(f'{database}.{table}__{old}')}")
        _delete(spark, f"{folder}/{old}")
    return written


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Names of the table's versions, oldest first."""
    found = (t.name for t in spark.catalog.listTables(database, f"{table}__v*"))
    return sorted(n.removeprefix(f"{table}__") for n in found)


def _fresh(versions: list[str]) -> str:
    """A name after all there are; two writers at once get two names."""
    number = int(versions[-1][1:13]) + 1 if versions else 0
    return f"v{number:012d}_{uuid.uuid4().hex[:8]}"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
