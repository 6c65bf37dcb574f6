"""Reversible line deduplication: sharded cuckoo filters over exact counts.

A line's key is the line without white space at its ends, A-Z lower-cased. A
``LineIndex`` knows in how many documents every key stands. Keys found in at
least ``least`` documents are removable, and ``clean`` drops their lines.

* The reference counts are an exact table: one row per key. Documents are added
  (``insert``) and taken out again (``delete``); counts go up and down by what the
  documents hold, so an insertion and its deletion leave the index as it was.
* Over the removable keys of each shard lies a cuckoo filter. Keys that reach the
  limit are inserted into it, keys that fall under it are deleted, which a Bloom
  filter could not do. Only a shard that outgrows its filter is built anew from
  the table. Fingerprints that find no slot go to a short list beside the
  buckets, so no key is ever missing.
* ``clean`` sends line keys to the shards' filters, and only those that pass, the
  removable ones and one in some ten thousand others, to the exact table.

The number of shards follows the counts, so a filter (KEYS_PER_SHARD) and the
keys a task tests (PLACES_PER_SHARD) stay bounded. Hot lines never meet in one
task: counts are aggregated partially, and keys that make up at least one in
HEAVY of all places, of which there can be no more than HEAVY, are known to every
task and marked where they are read. Texts are shuffled once, to meet their
lines. Tables between steps are stored in the shared folder, so that lost
executors repeat their own tasks only.

Defined cases: a null text is an empty one, and both are one empty line; lines of
white space alone have an empty key and always stay; a text that loses all lines
is empty; every row is a document of its own, also where id and text repeat; a
null id is kept; other columns than those asked for are not read; no rows give no
rows. A key is known by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.llm.near import merged_join
from mercato.llm.text import LOWER, SPACED, _powers, mix, span_hashes, text_chunks
from mercato.plans.session import discard, materialize

#: Documents that a line must stand in to be dropped.
LEAST_DOCUMENTS = 10
#: Removable keys in one filter, and places of keys that one task tests.
KEYS_PER_SHARD, PLACES_PER_SHARD = 1 << 20, 1 << 18
#: Keys with at least one in HEAVY of all places are sent to every task.
HEAVY = 10_000

SLOTS, KICKS = 4, 500
#: Share of slots up to which a filter is filled before it is built anew.
LOAD = 0.9
_OTHER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class CuckooFilter:
    """A set of (k1, k2) keys as 16-bit fingerprints with two buckets each.

    ``contains`` never denies a member. Keys may be deleted, but only members.
    """

    def __init__(self, expected: int = 0, table: bytes | None = None, stash: bytes = b"") -> None:
        if table is None:
            buckets = 1 << max(0, int(expected / (SLOTS * LOAD))).bit_length()
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()
        self.mask = len(self.table) - 1
        self.stash: list[tuple[int, int]] = [tuple(x) for x in np.frombuffer(stash, np.int64).reshape(-1, 2).tolist()]

    @property
    def room(self) -> int:
        """Keys it is made for."""
        return int(self.table.size * LOAD)

    def to_bytes(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.asarray(self.stash, np.int64).tobytes()

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys. A shard is picked by the low
        bits of k1, so the fingerprint takes the high ones."""
        mark = np.maximum(k1.astype(np.int64).view(np.uint64) >> np.uint64(48), np.uint64(1))
        one = k2.astype(np.int64).view(np.uint64) & np.uint64(self.mask)
        return mark, one, one ^ self._step(mark)

    def _step(self, mark: np.ndarray) -> np.ndarray:
        return mix(mark * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(self.mask)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(k1, k2)
        found = ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)
        for m, bucket in self.stash:
            found |= (mark == m) & ((one == bucket) | (two == bucket))
        return found

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for mark, one, two in zip(*(x.tolist() for x in self._places(k1, k2))):
            self._put(mark, one, two)

    def _put(self, mark: int, one: int, two: int) -> None:
        for bucket in (one, two):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return
        bucket = one
        for kick in range(KICKS):
            slot = (mark + kick) % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket ^= int(self._step(np.asarray([mark], np.uint64))[0])
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return
        self.stash.append((mark, bucket))

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for mark, one, two in zip(*(x.tolist() for x in self._places(k1, k2))):
            for bucket in (one, two):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break
                if (mark, bucket) in self.stash:
                    self.stash.remove((mark, bucket))
                    break
            else:
                raise KeyError("not in the filter")


class Lines:
    """Lines of some rows: row, span in bytes, and both hashes of the key (of lines
    with a key)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray) -> None:
        rows = len(offs) - 1
        breaks = np.flatnonzero(buf == 0x0A)
        row = np.searchsorted(offs, breaks, side="right") - 1
        starts = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
        self.per_row = 1 + np.bincount(row, minlength=rows)
        self.row = np.repeat(np.arange(rows), self.per_row)
        last = np.cumsum(self.per_row) - 1
        ends = np.append(starts[1:], 0) - 1
        ends[last] = offs[1:]
        inked = np.flatnonzero(SPACED[buf])
        left, right = np.searchsorted(inked, starts), np.searchsorted(inked, ends) - 1
        self.keyed = np.flatnonzero(left <= right)
        low = LOWER[buf]
        begin, end = inked[left[self.keyed]], inked[right[self.keyed]] + 1
        self.k1 = span_hashes(low, begin, end).view(np.int64)
        self.k2 = _other_hashes(low, begin, end).view(np.int64)


def _other_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of byte spans: a polynomial over random words, one a byte value."""
    power, inverse = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_OTHER[buf] * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, Lines]]:
    for lo, hi, buf, offs in text_chunks(texts):
        yield lo, hi, Lines(buf, offs)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Positions of one row of every distinct combination."""
    order = np.lexsort(columns)
    fresh = np.ones(len(order), bool)
    for k, c in enumerate(columns):
        changed = c[order][1:] != c[order][:-1]
        fresh[1:] = changed if k == 0 else fresh[1:] | changed
    return order[fresh]


def line_counts(texts: DataFrame) -> DataFrame:
    """k1, k2 and n, the number of rows of ``texts`` (one column) with that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, lines in _chunks(batch.column(0)):
                row = lines.row[lines.keyed]
                once = _distinct(row, lines.k2, lines.k1)  # by k1, then k2
                k1, k2 = lines.k1[once], lines.k2[once]
                heads = np.ones(len(k1), bool)
                heads[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
                first = np.flatnonzero(heads)
                n = np.diff(np.append(first, len(k1)))
                yield pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), pa.array(n)], names=["k1", "k2", "n"])

    return texts.mapInArrow(run, "k1 long, k2 long, n long").groupBy("k1", "k2").agg(F.sum("n").alias("n"))


def _shards_for(places: int, keys: int) -> int:
    need = max(-(-keys // KEYS_PER_SHARD), -(-places // PLACES_PER_SHARD), 1)
    return 1 << (need - 1).bit_length()


def _shard(shards: int):
    return F.col("k1").bitwiseAND(F.lit(shards - 1).cast("long"))


def _by_shard(rows: DataFrame) -> DataFrame:
    """Each shard in one task, in order of kind. The shuffle is by a hash of the
    shard: one by the shard itself is left out where both sides of the union seem
    to have it, and adaptive execution may then read these sides apart."""
    return rows.repartition(F.xxhash64("shard")).sortWithinPartitions("shard", "kind")


class LineIndex:
    """Reference counts and filters of a set of documents. ``insert`` and
    ``delete`` return a new index; the old one stays valid until ``discard``."""

    def __init__(self, spark: SparkSession, least: int = LEAST_DOCUMENTS) -> None:
        self.spark, self.least = spark, least
        self.counts: DataFrame | None = None  # k1, k2, n, change
        self.filters: DataFrame | None = None  # shard, hot, table, stash
        self.shards, self.places, self.hot = 1, 0, 0

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        return self._changed(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """The index without these documents, which must have been inserted."""
        return self._changed(docs, text_col, -1)

    def discard(self) -> None:
        """Delete the index's files."""
        discard(self.counts, self.filters)

    def removable(self) -> DataFrame:
        """k1, k2 and n of the keys that ``clean`` drops."""
        return self._known().filter(F.col("n") >= self.least)

    def _known(self) -> DataFrame:
        return self.counts.filter("n > 0").select("k1", "k2", "n")

    def _changed(self, docs: DataFrame, text_col: str, sign: int) -> LineIndex:
        new = LineIndex(self.spark, self.least)
        delta = line_counts(docs.select(F.col(text_col).cast("string"))).withColumn("n", sign * F.col("n"))
        if self.counts is None:
            both = delta.select("k1", "k2", F.lit(0).cast("long").alias("before"), "n")
        else:
            rows = self._known().select("k1", "k2", F.col("n").alias("before"), "n").unionByName(
                delta.withColumn("before", F.lit(0).cast("long"))
            )
            both = rows.groupBy("k1", "k2").agg(F.sum("before").alias("before"), F.sum("n").alias("n"))
        was, now = F.col("before") >= self.least, F.col("n") >= self.least
        change = F.when(now & ~was, 1).when(was & ~now, -1).otherwise(0)
        seen = Observation()
        new.counts = materialize(
            both.select("k1", "k2", "n", change.alias("change"))
            .observe(
                seen,
                F.sum("n").alias("places"),
                F.count_if(now).alias("hot"),
                F.count_if(F.col("n") < 0).alias("lost"),
            )
            .filter("n > 0 or change <> 0")
        )
        if seen.get["lost"]:
            new.discard()
            raise ValueError("documents to delete that were never inserted")
        new.places, new.hot = int(seen.get["places"] or 0), int(seen.get["hot"])
        new.shards = max(self.shards, _shards_for(new.places, new.hot))
        new.filters = materialize(new._filters_after(self))
        return new

    def _filters_after(self, old: LineIndex) -> DataFrame:
        """Filters of this index: those of ``old`` with the changes applied, or
        built anew where a shard's filter is too small or the shards changed."""
        shard = _shard(self.shards).alias("shard")
        sizes = self.removable().select(shard).groupBy("shard").agg(F.count("*").alias("hot"))
        if old.filters is None or old.shards != self.shards:
            heads = sizes.select("shard", "hot", F.lit(None).cast("binary").alias("table"), F.lit(None).cast("binary").alias("stash"))
        else:
            held = old.filters.select("shard", "table", "stash")
            fits = F.col("hot") <= F.octet_length("table") / 2 * LOAD
            heads = held.join(sizes, "shard", "full").select(
                "shard",
                F.coalesce("hot", F.lit(0)).alias("hot"),
                *[F.when(fits | F.col("hot").isNull(), F.col(c)).alias(c) for c in ("table", "stash")],
            )
        anew = heads.filter("table is null").select("shard")
        keys = self.counts.filter(f"n >= {self.least} or change <> 0").select(shard, "k1", "k2", "change", "n")
        whole = keys.join(anew, "shard", "left_semi").filter(f"n >= {self.least}").withColumn("kind", F.lit(2))
        moved = keys.join(anew, "shard", "left_anti").filter("change <> 0")
        moved = moved.withColumn("kind", F.when(F.col("change") < 0, 1).otherwise(2))
        rows = whole.unionByName(moved).select("shard", "kind", "k1", "k2")
        rows = rows.unionByName(heads.withColumn("kind", F.lit(0)), allowMissingColumns=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state: CuckooFilter | None = None
            at = hot = None

            def done():
                table, stash = state.to_bytes()
                return pa.RecordBatch.from_pylist([{"shard": at, "hot": hot, "table": table, "stash": stash}], FILTER_ROWS)

            for batch in batches:
                for shard, kind, part in _runs(batch):
                    if kind == 0:
                        if state is not None:
                            yield done()
                        row = part.slice(0, 1).to_pylist()[0]
                        at, hot = shard, row["hot"]
                        state = CuckooFilter(hot, row["table"], row["stash"] or b"")
                    else:
                        k1, k2 = (part.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
                        (state.delete if kind == 1 else state.insert)(k1, k2)
            if state is not None:
                yield done()

        placed = _by_shard(rows.select("shard", "kind", "k1", "k2", "hot", "table", "stash"))
        return placed.mapInArrow(run, "shard long, hot long, table binary, stash binary")

    def heavy(self) -> tuple[np.ndarray, np.ndarray]:
        """Removable keys with at least one in HEAVY of all places, at most HEAVY."""
        rows = self.removable().filter(F.col("n") * HEAVY >= self.places).select("k1", "k2").toArrow()
        k1, k2 = (rows[c].to_numpy().astype(np.int64) for c in ("k1", "k2"))
        order = np.lexsort((k2, k1))
        return k1[order], k2[order]

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
        """Per document: doc_id, text (without the dropped lines), n_lines
        (before), n_dropped, and the ``keep`` columns of docs as a struct ``row``."""
        doc_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        rows = docs.select(
            doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("doc_key"), F.coalesce(doc_id, F.lit(0)).alias("doc_at"),
            text.alias("text"), *([F.struct(*keep).alias("row")] if keep else []),
        )
        heavy = self.heavy()
        drops = self._places_to_drop(rows.select("doc_at", "doc_key", "text"), heavy)
        by_doc = drops.groupBy("doc_at", "doc_key").agg(F.collect_set(F.struct("k1", "k2")).alias("drops"))
        extra = f", row {rows.schema['row'].dataType.simpleString()}" if keep else ""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, lines in _chunks(batch.column("text")):
                    part = batch.slice(lo, hi - lo)
                    gone = np.zeros(len(lines.row), bool)
                    gone[lines.keyed] = _in_sorted(lines.k1, lines.k2, *heavy)
                    own = {i: {(d["k1"], d["k2"]) for d in found} for i, found in enumerate(part.column("drops").to_pylist()) if found}
                    if own:
                        for line, row, k1, k2 in zip(lines.keyed.tolist(), lines.row[lines.keyed].tolist(), lines.k1.tolist(), lines.k2.tolist()):
                            if row in own and (k1, k2) in own[row]:
                                gone[line] = True
                    dropped = np.bincount(lines.row[gone], minlength=part.num_rows)
                    texts, first = part.column("text").to_pylist(), np.cumsum(lines.per_row) - lines.per_row
                    for i in np.flatnonzero(dropped).tolist():
                        flags = gone[first[i] : first[i] + lines.per_row[i]].tolist()
                        texts[i] = "\n".join(t for t, g in zip(texts[i].split("\n"), flags) if not g)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(texts, pa.large_string()), pa.array(lines.per_row), pa.array(dropped), *([part.column("row")] if keep else [])],
                        names=["doc_id", "text", "n_lines", "n_dropped", *(["row"] if keep else [])],
                    )

        return merged_join(rows, by_doc, ["doc_at", "doc_key"], "left").mapInArrow(run, f"doc_id long, text string, n_lines long, n_dropped long{extra}")

    def _places_to_drop(self, docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        """doc_at, doc_key, k1, k2 of removable keys that are not heavy."""

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, _, lines in _chunks(batch.column(2)):
                    row = lines.row[lines.keyed]
                    once = _distinct(row, lines.k2, lines.k1)
                    once = once[~_in_sorted(lines.k1[once], lines.k2[once], *heavy)]
                    of = pa.array(row[once] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(of), batch.column(1).take(of), pa.array(lines.k1[once]), pa.array(lines.k2[once])],
                        names=["doc_at", "doc_key", "k1", "k2"],
                    )

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, state = None, None
            for batch in batches:
                for shard, kind, part in _runs(batch):
                    if kind == 0:
                        row = part.slice(0, 1).to_pylist()[0]
                        at, state = shard, CuckooFilter(0, row["table"], row["stash"])
                    elif at == shard:
                        k1, k2 = (part.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
                        yield part.select(["doc_at", "doc_key", "k1", "k2"]).filter(pa.array(state.contains(k1, k2)))

        found = docs.mapInArrow(places, "doc_at long, doc_key long, k1 long, k2 long")
        asked = found.withColumn("shard", _shard(self.shards)).withColumn("kind", F.lit(1))
        heads = self.filters.select("shard", "table", "stash", F.lit(0).alias("kind"))
        rows = _by_shard(asked.unionByName(heads, allowMissingColumns=True))
        passed = rows.mapInArrow(probe, "doc_at long, doc_key long, k1 long, k2 long")
        return merged_join(passed, self.removable().select("k1", "k2"), ["k1", "k2"], "left_semi")


FILTER_ROWS = pa.schema([("shard", pa.int64()), ("hot", pa.int64()), ("table", pa.binary()), ("stash", pa.binary())])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Successive rows of one shard and kind; kind 0 rows one by one."""
    if not batch.num_rows:
        return
    shard, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
    new = np.ones(len(shard), bool)
    new[1:] = (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 0)
    first = np.flatnonzero(new).tolist()
    for lo, hi in zip(first, [*first[1:], len(shard)]):
        yield int(shard[lo]), int(kind[lo]), batch.slice(lo, hi - lo)


def _in_sorted(k1: np.ndarray, k2: np.ndarray, of_k1: np.ndarray, of_k2: np.ndarray) -> np.ndarray:
    """Which keys are among the given ones (sorted by k1, then k2)."""
    out = np.zeros(len(k1), bool)
    at, end = np.searchsorted(of_k1, k1), np.searchsorted(of_k1, k1, side="right")
    while (at < end).any():  # keys with an equal k1 are next to each other
        here = np.flatnonzero(at < end)
        out[here] |= of_k2[at[here]] == k2[here]
        at[here] += 1
    return out


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCUMENTS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``LineIndex.clean`` of documents by their own lines."""
    return LineIndex(docs.sparkSession, least).insert(docs, text_col).clean(docs, id_col, text_col, keep)
