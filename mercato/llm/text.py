"""Byte-level text helpers for Arrow batches (numpy inside tasks).

Texts stay in the UTF-8 buffer Arrow hands over. Every delimiter the word rules
know is ASCII, so cutting words on bytes gives the same words as cutting on
characters. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch of texts, and what Spark has where nobody sets it.
BATCH_ROWS, SPARKS_BATCH_ROWS = 500, 10_000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of BATCH_ROWS, unless the session has
    a number of its own: ten thousand texts are tens of megabytes, which the JVM
    and every worker hold several times over. It holds for the session, since
    plans run after the function that made them returns."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == str(SPARKS_BATCH_ROWS):
        spark.conf.set(name, str(BATCH_ROWS))


#: Bytes of text worked on at once; one longer text is worked on alone.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)


def _spaced_table() -> np.ndarray:
    """True for bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t


def _alnum_table() -> np.ndarray:
    """True for bytes of words of digits, letters and everything beyond ASCII."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = t[0x80:] = True
    return t


SPACED = _spaced_table()
ALNUM = _alnum_table()
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES, most_rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of successive runs of rows.

    A run has at most ``most`` bytes and ``most_rows`` rows, or a single row
    that is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + most_rows)
        yield lo, hi, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def split_words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words, and per row the index of
    its first word (one more entry at the end). No word crosses a row's end."""
    n = len(buf)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    inside = table[buf]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    begin[heads] = inside[heads]
    tails = offs[1:][offs[:-1] < offs[1:]] - 1
    end[tails] = inside[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _POW = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)])
            _INV = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, inverse, np.uint64)])
        if size > 4 * CHUNK_BYTES:  # do not keep what one very long text needed
            pair, _POW, _INV = (_POW, _INV), _POW[: CHUNK_BYTES + 1].copy(), _INV[: CHUNK_BYTES + 1].copy()
            return pair
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span (a polynomial over its bytes, mixed)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of words, from the words' hashes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for k in range(1, size):
        total *= np.uint64(_BASE)
        total += words[k : k + n]
    return mix(total)


def row_windows(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row) of the windows that lie within one row; a row with words,
    but fewer than ``size``, gives its whole sequence as one window."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    every = window_hashes(words, size)
    whole = rows[: len(every)] == rows[size - 1 :][: len(every)]
    hashes, owner = every[whole], rows[: len(every)][whole]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j, r in enumerate(short):
            extra[j] = window_hashes(words[first[r] : first[r + 1]], int(n[r]))[0] ^ np.uint64(n[r])
        order = np.argsort(np.r_[owner, short], kind="stable")
        hashes, owner = np.r_[hashes, extra][order], np.r_[owner, short][order]
    return hashes, owner


def row_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's [offs[i], offs[i+1])."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


#: Rows whose sets are made at once; their numbers share a 64-bit key with 55 bits of hash.
SET_ROWS = 512


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(items, first): the distinct word shingles of each of at most SET_ROWS
    rows as sorted 55-bit hashes, and the index of each row's first item."""
    starts, ends, first = split_words(buf, offs, SPACED)
    hashes, owner = row_windows(span_hashes(buf, starts, ends), first, size)
    return distinct_by_row(hashes, owner, len(offs) - 1)


def distinct_by_row(hashes: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.sort((owner.astype(np.uint64) << np.uint64(55)) | (hashes >> np.uint64(9)))
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    both = both[fresh]
    first = np.searchsorted(both, np.arange(rows + 1, dtype=np.uint64) << np.uint64(55)) if rows < SET_ROWS else np.r_[
        np.searchsorted(both, np.arange(rows, dtype=np.uint64) << np.uint64(55)), len(both)
    ]
    return both & np.uint64((1 << 55) - 1), first


def set_ids(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's set (0 for an empty one), as signed integers."""
    n = np.diff(first).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(items.copy()), dtype=np.uint64)])
    out = mix(total[first[1:]] - total[first[:-1]] + n * np.uint64(_BASE))
    return np.where(n > 0, out, np.uint64(0)).view(np.int64)


def list_array(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Arrow lists of signed integers, cut at ``first``."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.uint64).view(np.int64)))
