"""Rows of numbers that go from task to task as blobs, a bucket of keys each.

Spark moves, sorts and aggregates single rows one by one. Where there are tens of
millions of small ones, tasks put up to FLUSH of them in the order of a 64-bit key
and hand on one row a bucket (the highest bits of the key) with a binary column for
each number; those of a bucket meet in one task, which gets them sorted by bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that a task collects before it hands them on, and the bytes of blobs from
#: which a task works on the buckets that it has in whole.
FLUSH, WORK_BYTES = 1 << 20, 16 << 20

#: Rows that a bucket has about, from 1024 buckets on.
BUCKET_ROWS = 1 << 16

#: Rows from which a task is worth its start.
TASK_ROWS = 200_000


def bucket_bits(rows: int) -> int:
    """Bits for buckets of about BUCKET_ROWS rows each."""
    return min(max(10, (max(rows, 1) // BUCKET_ROWS).bit_length()), 24)


def blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Binary values: the numbers of each [first[i], first[i + 1])."""
    data = np.ascontiguousarray(values)
    offsets = (first * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def numbers(column: pa.Array | pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all values of a binary column without nulls, and the index of
    the first number of each (one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = bytearray() if data is None else bytearray(memoryview(data)[offs[0] : offs[-1]])
    return np.frombuffer(raw, dtype), (offs - offs[0]) // np.dtype(dtype).itemsize


def by_bucket(key: np.ndarray, bits: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row a bucket; ``key`` (uint64) is in order, the columns go with it."""
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    first = np.append(at, len(bucket))
    return pa.RecordBatch.from_arrays([pa.array(bucket[at]), *(blobs(c, first) for c in columns.values())], names=["bucket", *columns])


def flushes(parts: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The columns of successive parts, put together from FLUSH rows on; never none."""
    held, size = [], 0
    for part in parts:
        if len(part[0]):
            held.append(part)
            size += len(part[0])
        if size >= FLUSH:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def schema(*names: str) -> str:
    return ", ".join(["bucket long", *(f"{n} binary" for n in names)])


def meeting(rows: DataFrame, n: int) -> DataFrame:
    """Rows of a bucket next to each other in one task; at most one task for
    TASK_ROWS of the ``n`` rows that the blobs hold about."""
    return rows.repartition("bucket").sortWithinPartitions("bucket").coalesce(max(1, -(-n // TASK_ROWS)))


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole buckets, from the batches of a task of ``meeting``."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        last = batch.column(0)[-1].as_py()
        if size < WORK_BYTES or held[0].column(0)[0].as_py() == last:
            continue
        table = pa.Table.from_batches(held)
        n = int(np.flatnonzero(table.column(0).to_numpy() != last)[-1]) + 1
        yield table.slice(0, n)
        held = [b for b in table.slice(n).to_batches() if b.num_rows]
        size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)
