"""Audit of a folder of CSV files, each file on its own.

Every file is a source with a header of its own. Files that can't be read are
reported with the reason, and the totals of all others are as if they were not
there. A file is unreadable if it is empty, if its bytes can't be decoded (a
broken or cut-off gzip file), or if a line has more fields than the header.

Files are listed by Spark, their first lines found in one pass, and the files of
one header are then read together: one scan and one aggregate per distinct
header, not per file. Values stay text until it is known, per file and column,
that all of them are numbers, as a reader that infers types would have it. Sums
have the two exact parts of operators/profile.py.
"""

from __future__ import annotations

import csv
import gzip
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.profile import SUM_TYPE
from mercato.plans.session import materialize

#: Texts that stand for no value.
MISSING = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None"]
#: Distinct headers a folder may have; each is a read of its own.
MOST_HEADERS = 1000
#: Texts that are numbers.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Infinity)$"
FOUND = (
    "path string, n_rows long, too_long long, "
    "columns array<struct<column_name:string,numeric:boolean,total:decimal(38,6),rest:double>>"
)


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path and error of the files with bytes; these are read of gzip files only, for
    which the listing is narrowed by name: a filter by path comes after the read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    matching = F.broadcast(files.select("path").filter(F.col("path").endswith(".gz")))
    gzips = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(folder)
    plain = files.filter(~F.col("path").endswith(".gz")).select("path", F.lit(None).cast("string").alias("error"))

    def unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = []
            for content in batch.column("content"):
                try:
                    with gzip.open(io.BytesIO(content.as_buffer())) as f:
                        while f.read(1 << 20):
                            pass
                    errors.append(None)
                except (OSError, EOFError, zlib.error) as exc:
                    errors.append(f"unreadable: {exc}")
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(errors, pa.string())], names=["path", "error"])

    zipped = gzips.select("path", "content").join(matching, "path", "left_semi").mapInArrow(unzipped, "path string, error string")
    return plain.unionByName(zipped)


def _empty(spark: SparkSession, folder: str, pattern: str, with_bytes: list[str]) -> list[str]:
    """Paths of files without a byte, which no read returns."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    short = lambda path: re.sub("^([a-z]+):/+(?=[^/]*/)", r"\1:/", path)
    known = {short(p) for p in with_bytes}
    return sorted({short(unquote(p)) for p in reader.load(folder).inputFiles()} - known)


def _header_names(line: str) -> list[str]:
    names: list[str] = []
    for name in next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")])):
        k, fresh = 1, name
        while fresh in names:
            fresh, k = f"{name}.{k}", k + 1
        names.append(fresh)
    return names


def _plain(path: Column) -> Column:
    """A path as the listing has it: file:///x and file:/x are one."""
    return F.regexp_replace(path, "^([a-z]+):/+(?=[^/]*/)", "$1:/")


def _read_from() -> Column:
    """Path of the file a row was read from (it is percent-encoded there)."""
    return _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def _first_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path and header of every file, from lines of the files' first blocks."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(folder)
    place = F.monotonically_increasing_id()  # rises within a block
    first = lines.select(_read_from().alias("path"), "_metadata.file_block_start", "value", place.alias("place"))
    return first.filter("file_block_start = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))


def _totals(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """path, n_rows, too_long and columns (column_name, numeric, total, rest)."""
    fields = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*fields, "too_many"]])
    rows = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("ignoreCorruptFiles", True).csv(paths)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count("too_many").alias("too_long")]
    for c in fields:
        value = F.when(~F.trim(c).isin(MISSING), F.trim(c))
        number = F.when(value.rlike(NUMBER), value.try_cast("double"))
        head = F.when(F.abs(number) < 1e31, number).cast(SUM_TYPE)
        aggs += [
            F.count_if(value.isNotNull() & number.isNull()).alias(f"{c}_text"),
            F.coalesce(F.sum(head), F.lit(0).cast(SUM_TYPE)).alias(f"{c}_total"),
            F.coalesce(F.sum(number - F.coalesce(head.cast("double"), F.lit(0.0))), F.lit(0.0)).alias(f"{c}_rest"),
        ]
    per_column = F.array(*[
        F.struct(
            F.lit(n).alias("column_name"), (F.col(f"{c}_text") == 0).alias("numeric"),
            F.col(f"{c}_total").alias("total"), F.col(f"{c}_rest").alias("rest"),
        )
        for c, n in zip(fields, names)
    ])
    by_file = rows.groupBy(_read_from().alias("path")).agg(*aggs)
    return by_file.select("path", "n_rows", "too_long", per_column.alias("columns"))


def audit_csv_folder(spark: SparkSession, folder: str, pattern: str = "*.csv*", by_folder: bool = False) -> DataFrame:
    """Rows of one of four kinds:

    * column_name, source, total: a numeric column's sum in one source;
    * column_name, total: its sum over all readable files (source null);
    * source, n_rows: a source's readable rows; n_rows alone: the rows of all;
    * source, error: what could not be read of a source.

    A source is a file, or with ``by_folder`` the files of one sub-folder, of which
    the unreadable ones are left out. The driver holds the list of files, as for
    any read, and their headers.
    """
    source = F.element_at(F.split("path", "/"), -2 if by_folder else -1).alias("source")
    files = _listed(spark, folder, pattern)
    heads = _first_lines(spark, folder, pattern).select(F.col("path").alias("plain"), "header")
    listed = files.join(heads, _plain(files["path"]) == heads["plain"], "left").select("path", source, "error", "header").collect()
    by_header: dict[str, list[str]] = {}
    errors = [(f.source, f.error) for f in listed if f.error]
    errors += [(p.split("/")[-2 if by_folder else -1], "empty file") for p in _empty(spark, folder, pattern, [f.path for f in listed])]
    for f in listed:
        if not f.error:
            by_header.setdefault(f.header or "", []).append(f.path)
    if len(by_header) > MOST_HEADERS:
        raise ValueError(f"{folder}: more than {MOST_HEADERS} different headers")
    found = spark.createDataFrame([], FOUND)
    for header, paths in sorted(by_header.items()):
        found = found.unionByName(_totals(spark, paths, _header_names(header)))
    found = materialize(found)  # a row a file, read below for each kind of row
    good = found.filter("too_long = 0")
    too_long = found.filter("too_long > 0").groupBy(source).agg(F.sum("too_long").alias("n"))
    total = F.sum("total").cast("double") + F.sum("rest")
    columns = good.select(source, "n_rows", F.inline("columns")).filter("numeric and n_rows > 0")
    out = columns.rollup("column_name", "source").agg(total.alias("total")).filter("column_name is not null")
    for part in (
        good.select(source, "n_rows").rollup("source").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows")),
        too_long.select("source", F.concat(F.col("n").cast("string"), F.lit(" lines have more fields than the header")).alias("error")),
        spark.createDataFrame(errors, "source string, error string"),
    ):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("column_name", "source", "total", "n_rows", "error")
