"""Benchmark decontamination with suffix arrays of the training documents.

Every task cuts its documents into shards of about SHARD_WORDS words, sorts all
suffixes of a shard by prefix doubling (up to the longest benchmark item) and
binary-searches every suffix of every benchmark item in it. A hit is an
occurrence of a window: WINDOW consecutive words of an item, or all words of a
shorter item. Hits are compared with the item's own bytes, joined along their
diagonal into the longest verbatim matches, and reported with their places.
Documents are neither shuffled nor collected.

The benchmark goes to the tasks in blocks of bounded size; a benchmark of
several blocks takes one pass each, and the passes are merged by row.

Defined cases: a null or wordless text has no words and no hits; an item
without words is never found; an empty benchmark leaves every document clean;
repeated rows are separate documents; items that share an id count once; an item
without an id hits like any other, but is not among the items named.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import ALNUM, LOWER, span_hashes, split_words, text_chunks

WINDOW = 13
SHARD_WORDS = 900_000
#: Bytes of benchmark text that go to the tasks at once.
BLOCK_BYTES = 16 << 20

MATCH_TYPE = "array<struct<item_id:string,item_start:long,doc_start:long,length:long>>"
_PACK = 1 << 20


def word_bytes(text: str | None) -> list[bytes]:
    buf = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = split_words(buf, np.asarray([0, len(buf)]), ALNUM)
    raw = buf.tobytes()
    return [raw[s:e] for s, e in zip(starts, ends)]


def _ranked(keys_high: np.ndarray, keys_low: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank of every position, order, sorted distinct keys) of the pair keys.

    With at most 2**20 positions, key and position are sorted as one integer.
    """
    n = len(keys_high)
    key = keys_high if keys_low is None else (keys_high << np.uint64(bits)) | keys_low
    if n <= _PACK and 2 * bits <= 44:
        both = np.sort((key << np.uint64(20)) | np.arange(n, dtype=np.uint64))
        order, ordered = (both & np.uint64(_PACK - 1)).astype(np.int64), both >> np.uint64(20)
    else:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.uint64)
    rank[order] = np.cumsum(fresh).astype(np.uint64)  # from 1; 0 stands for "past the end"
    return rank, order, ordered[fresh]


class Shard:
    """Suffix array over the word hashes of some documents.

    ``symbols`` has 0 after every document, so no match runs across two.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.n = len(symbols)
        self.bits = max(1, int(self.n + 2).bit_length())
        self.symbols = symbols
        first, self.order, distinct = _ranked(symbols, None, 22 if self.n <= _PACK else 32)
        self.ranks, self.keys, self.depth = [first], [distinct], 1

    def deepen(self) -> None:
        last = self.ranks[-1]
        ahead = np.zeros(self.n, np.uint64)
        ahead[: max(0, self.n - self.depth)] = last[self.depth :]
        rank, self.order, distinct = _ranked(last, ahead, self.bits)
        self.ranks.append(rank)
        self.keys.append(distinct)
        self.depth *= 2

    def level(self, k: int) -> np.ndarray:
        while len(self.ranks) <= k:
            self.deepen()
        return self.keys[k]

    def interval(self, symbols: np.ndarray, level: int, found: np.uint64) -> tuple[int, int]:
        """Range of the suffix order whose suffixes start with ``symbols``; the
        first 2**level of them are known to have rank ``found``."""
        ranked = self.sorted_rank(level)
        found = np.uint64(found)  # of the ranks' own type, or the whole array is converted
        lo, hi = int(np.searchsorted(ranked, found, "left")), int(np.searchsorted(ranked, found, "right"))
        for d in range(1 << level, len(symbols)):
            at = np.minimum(self.order[lo:hi] + d, self.n - 1)
            here = self.ranks[0][at]
            lo, hi = (
                lo + int(np.searchsorted(here, symbols[d], "left")),
                lo + int(np.searchsorted(here, symbols[d], "right")),
            )
            if lo == hi:
                break
        return lo, hi

    def sorted_rank(self, level: int) -> np.ndarray:
        if not hasattr(self, "_sorted"):
            self._sorted: dict[int, np.ndarray] = {}
        if level not in self._sorted:
            self._sorted[level] = self.ranks[level][self.order]
        return self._sorted[level]


class Benchmark:
    """The items' words, and every place where a window starts."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.ids = [i for i, _ in items]
        self.words = [word_bytes(t) for _, t in items]
        self.window = window
        self.need = [min(window, len(w)) for w in self.words]
        flat = [w for words in self.words for w in words]
        raw = np.frombuffer(b"".join(flat), np.uint8)
        lengths = np.asarray([len(w) for w in flat], np.int64)
        ends = np.cumsum(lengths)
        self.hashes = span_hashes(raw, ends - lengths, ends)
        self.first = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64)
        self.longest = max((len(w) for w in self.words), default=0)
        starts: dict[int, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.words):
            if words:
                level = self.need[i].bit_length() - 1
                starts.setdefault(level, []).extend((i, t) for t in range(len(words) - self.need[i] + 1))
        #: by level: window starts whose first 2**level words are looked up at once
        self.starts = {k: np.asarray(v, np.int64) for k, v in starts.items()}


def _symbol(hashes: np.ndarray, small: bool) -> np.ndarray:
    """Word hash to symbol; never 0."""
    return (hashes >> np.uint64(20 if small else 1)) | np.uint64(1)


def search(shard: Shard, bench: Benchmark, small: bool) -> Iterator[tuple[int, int, int]]:
    """(item, window start in the item, position in the shard) of every
    occurrence of every window, by symbol; the caller compares the bytes."""
    words = _symbol(bench.hashes, small)
    distinct = shard.keys[0]
    if not len(words) or not shard.n:
        return
    at = np.minimum(np.searchsorted(distinct, words), len(distinct) - 1)
    rank = np.where(distinct[at] == words, at + 1, 0).astype(np.uint64)
    first_rank = rank
    deepest = max(bench.starts, default=0)
    by_level = [rank]
    for k in range(deepest):
        ahead = np.zeros(len(words), np.uint64)
        step = 1 << k
        ahead[: max(0, len(words) - step)] = rank[step:]
        keys = shard.level(k + 1)
        key = (rank << np.uint64(shard.bits)) | ahead
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        rank = np.where((keys[at] == key) & (rank > 0) & (ahead > 0), at + 1, 0).astype(np.uint64)
        by_level.append(rank)
    alive = []
    for level, places in bench.starts.items():
        flat = bench.first[places[:, 0]] + places[:, 1]
        alive += [(level, int(i), int(t), int(f)) for (i, t), f in zip(places, flat) if by_level[level][f]]
    if not alive:
        return
    while shard.depth < bench.longest:
        shard.deepen()
    for level, item, start, flat in alive:
        symbols = first_rank[flat : flat + bench.need[item]]
        if (symbols == 0).any():
            continue
        lo, hi = shard.interval(symbols, level, by_level[level][flat])
        for p in shard.order[lo:hi]:
            yield item, start, int(p)


def _scan(texts: pa.Array, bench: Benchmark) -> list[tuple[int, list[tuple[str, int, int, int]]]]:
    """Per row: its number of words and its longest verbatim matches."""
    n_rows = len(texts)
    n_words = np.zeros(n_rows, np.int64)
    found: list[list[tuple[str, int, int, int]]] = [[] for _ in range(n_rows)]
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if not held:
            return
        parts, rows, spot = [], [], []
        for k, (row0, buf, starts, ends, first, hashes) in enumerate(held):
            counts = np.diff(first)
            rows_of = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(hashes)) + rows_of  # one separator after every row
            symbols = np.zeros(len(hashes) + len(counts), np.uint64)
            symbols[place] = hashes
            parts.append(symbols)
            owner = np.repeat(np.arange(len(counts)), counts + 1)
            rows.append(owner + row0)
            word = np.full(len(symbols), -1, np.int64)
            word[place] = np.arange(len(hashes))
            spot.append(np.stack([np.full(len(symbols), k), word], 1))
        raw = np.concatenate(parts)
        row_of, spots = np.concatenate(rows), np.concatenate(spot)
        small = len(raw) <= _PACK
        shard = Shard(np.where(raw > 0, _symbol(raw, small), np.uint64(0)))
        diagonals: dict[tuple[int, int, int], list[int]] = {}
        for item, start, p in search(shard, bench, small):
            k, w = spots[p]
            _, buf, starts, ends, first, _ = held[k]
            need = bench.need[item]
            if w < 0 or w + need > len(starts):
                continue
            if any(
                buf[starts[w + j] : ends[w + j]].tobytes() != bench.words[item][start + j] for j in range(need)
            ):
                continue  # two words of one hash
            row = int(row_of[p])
            at = int(w) - int(first[row - held[k][0]])
            diagonals.setdefault((row, item, at - start), []).append(at)
        for (row, item, shift), places in sorted(diagonals.items()):
            places.sort()
            lo = last = places[0]
            for p in [*places[1:], None]:
                if p is None or p > last + bench.need[item]:
                    found[row].append((bench.ids[item], lo - shift, lo, last + bench.need[item] - lo))
                    lo = p
                last = p
        held, size = [], 0

    for lo, hi, buf, offs in text_chunks(texts):
        low = LOWER[buf]
        starts, ends, first = split_words(low, offs, ALNUM)
        n_words[lo:hi] = np.diff(first)
        hashes = span_hashes(low, starts, ends)
        if held and size + len(hashes) + (hi - lo) > SHARD_WORDS:
            flush()
        held.append((lo, low, starts, ends, first, hashes | np.uint64(1)))
        size += len(hashes) + (hi - lo)
    flush()
    return list(zip(n_words.tolist(), found))


def union_length(spans: str) -> Column:
    """Words covered by an array of (doc_start, length) structs."""
    return F.expr(
        f"aggregate(array_sort(transform({spans}, m -> struct(m.doc_start as s, m.doc_start + m.length as e))), "
        "struct(0L as upto, 0L as total), (a, m) -> struct(greatest(a.upto, m.e) as upto, "
        "a.total + greatest(0L, m.e - greatest(a.upto, m.s)) as total), a -> a.total)"
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, matches (longest verbatim matches: item,
    place in the item, place in the document, length, in words), n_hit (words
    inside a match), items (distinct item ids, sorted as strings), contaminated
    (n_hit > 0 and 20 * n_hit >= n_words), and the ``keep`` columns of docs as a
    struct ``row``."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    ).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    wanted = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.struct(*keep).alias("row")] if keep else []),
    )
    if blocks > 1:
        wanted = wanted.withColumn("row_key", F.monotonically_increasing_id())
    names = [c for c in wanted.columns if c != "text"]
    fields = ", ".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in names)
    schema = f"{fields}, n_words long, matches {MATCH_TYPE}"
    match_type = pa.list_(
        pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())])
    )

    def one_pass(block: int) -> DataFrame:
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        bench = Benchmark([(r.item_id, r.text) for r in mine.collect()], window)  # at most about block_bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = _scan(batch.column(1), bench)
                matches = [
                    [dict(zip(("item_id", "item_start", "doc_start", "length"), m)) for m in row] for _, row in got
                ]
                rest = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([n for n, _ in got], pa.int64()), pa.array(matches, match_type)],
                    names=[*names, "n_words", "matches"],
                )

        return wanted.mapInArrow(run, schema)

    out = one_pass(0)
    for block in range(1, blocks):
        out = out.unionByName(one_pass(block))
    if blocks > 1:
        out = out.groupBy("row_key").agg(
            *[F.first(c).alias(c) for c in names if c != "row_key"],
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("matches")).alias("matches"),
        )
    out = out.withColumn("n_hit", union_length("matches")).withColumn(
        "items", F.array_sort(F.array_distinct(F.expr("filter(transform(matches, m -> m.item_id), i -> i is not null)")))
    )
    out = out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
    return out.select("doc_id", "n_words", "matches", "n_hit", "items", "contaminated", *(["row"] if keep else []))
