"""CSV with quoted line breaks, read in parallel within a file.

A reader that meets a line in the middle of a file can't know whether it stands
inside quotes; so Spark reads a file with quoted breaks whole, in one task. Here
the file is read as lines, by byte ranges like any text file, and records are put
together afterwards:

1. the parity of quotes in each range, an aggregate of one row a range. Quotes
   inside fields are doubled, so they don't change it;
2. a running parity over a file's ranges tells which ranges begin inside quotes;
3. every task walks the lines of its ranges with the running parity: a line that
   begins outside quotes begins a record. Records within a range are complete;
   the open ends of ranges (two a range at most) are joined in order of ranges;
4. records are parsed by Spark's own CSV parser.

The driver holds the list of ranges that begin inside quotes, at most one entry
per range of ``spark.sql.files.maxPartitionBytes``. As in RFC 4180, a quote may
stand only in a quoted field, where it is doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources.io import DATE_FORMAT, TS_FORMAT

OPENED, CONTINUED, CLOSED = 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the byte range) and value of every line, a range's in order."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def ranges_inside_quotes(lines: DataFrame) -> set[tuple[str, int]]:
    """(file, start) of the ranges that begin inside quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "start").agg(F.bit_xor(quotes.bitwiseAND(F.lit(1))).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = parity.withColumn("before", F.sum("odd").over(before) % 2).filter("before = 1")
    return {(r.file, r.start) for r in begins.select("file", "start").collect()}


class _Range:
    """Lines of one range, cut into records."""

    def __init__(self, file: str, start: int, inside: bool) -> None:
        self.file, self.start, self.inside = file, start, inside
        self.open: list[str] = []  # lines of the record that is open
        self.headless = inside  # that record began in an earlier range
        self.first = start == 0  # the next record is the file's first one

    def records(self, values: pa.Array) -> Iterator[tuple[int, str]]:
        """(kind, text) of what ends within these lines; kind 0 is a whole record."""
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        odd_lines = np.flatnonzero(quotes & 1).tolist()
        texts, at = values.to_pylist(), 0
        for line in [*odd_lines, len(texts)]:
            # the lines up to this one are all inside or all outside
            if self.inside:
                self.open += texts[at : line + 1]
                at = line + 1
                if line < len(texts):
                    yield (CLOSED if self.headless else 0), "\n".join(self.open)
                    self.open, self.headless, self.inside = [], False, False
            else:
                for text in texts[at:line]:
                    yield 0, text
                if line < len(texts):
                    self.open, self.inside = [texts[line]], True
                at = line + 1

    def rest(self) -> list[tuple[int, str]]:
        if not self.open:
            return []
        return [(CONTINUED if self.headless else OPENED, "\n".join(self.open))]


def _records(lines: DataFrame, inside: set[tuple[str, int]], whole: bool, header: bool) -> DataFrame:
    """file, start, kind and text of the whole records, or of the open ends.
    Blank lines between records and a file's header are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Range | None = None
        out: list[tuple[str, int, int, str]] = []

        def take(found) -> None:
            for kind, text in found:
                is_header = header and state.first and kind == 0
                state.first = False
                if (kind == 0) == whole and not is_header and (kind or text.strip("\r")):
                    out.append((state.file, state.start, kind, text))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out))
            arrays = [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.large_string())]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "kind", "text"])

        for batch in batches:
            file = batch.column("file").to_pylist()
            start = batch.column("start").to_numpy(zero_copy_only=False)
            new = [i for i in range(batch.num_rows) if i == 0 or start[i] != start[i - 1] or file[i] != file[i - 1]]
            for lo, hi in zip(new, [*new[1:], batch.num_rows]):
                if state is None or (state.file, state.start) != (file[lo], int(start[lo])):
                    if state is not None:
                        take(state.rest())
                    state = _Range(file[lo], int(start[lo]), (file[lo], int(start[lo])) in inside)
                take(state.records(batch.column("value").slice(lo, hi - lo)))
            if out:
                yield rows()
                out.clear()
        if state is not None:
            take(state.rest())
        if out:
            yield rows()

    return lines.mapInArrow(run, "file string, start long, kind int, text string")


def _joined(ends: DataFrame) -> DataFrame:
    """Records that lie in several ranges, from their open ends."""
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == OPENED)
    numbered = ends.withColumn("record", F.count_if(F.col("kind") == OPENED).over(order))
    parts = F.sort_array(F.collect_list(F.struct("start", F.col("kind") == OPENED, "text")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, empty_text: bool = False
) -> DataFrame:
    """Typed scan of CSV files whose quoted fields may hold line breaks, each file
    read by as many tasks as it has ranges. Columns are matched by name where there
    is a header, and a malformed value fails the read, as in ``read_csv``. Line ends
    inside quotes are kept as they are, \\r\\n included. A quoted
    empty text is null as there, or with ``empty_text`` an empty text."""
    names = schema.names
    if header:
        names = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).columns
        missing = [c for c in schema.names if c not in names]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {', '.join(names)}")
    found = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in names])
    lines = _lines(spark, path)
    inside = ranges_inside_quotes(lines)
    records = _records(lines, inside, True, header).select("text")
    if inside:
        records = records.unionByName(_joined(_records(lines, inside, False, header)).select("text"))
    options = {
        "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true",
        **({"nullValue": "\u0000"} if empty_text else {}),  # what stands for nothing but a field left out
        "timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT, "dateFormat": DATE_FORMAT,
    }
    parsed = F.from_csv(F.rtrim("text", F.lit("\r")), F.lit(found.toDDL()), options)
    return records.select(parsed.alias("row")).select("row.*").select(*schema.names)
