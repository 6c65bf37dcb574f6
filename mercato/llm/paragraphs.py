"""Substring deduplication by MinHash banding of paragraphs.

Two kinds of paragraphs are compared across the whole corpus:

* lines of at least MIN_WORDS words. Each has BANDS bucket keys, the minima of
  its five-word shingles under BANDS hash functions, one a band (tuned for
  recall: at a similarity of 0.75 a pair misses all with 0.25**5, 0.1 %).
  Colliding lines are joined, confirmed by the exact Jaccard similarity of their
  shingle sets (0.75 or more) and clustered by components;
* pieces of running text, for passages inside lines. Text is cut where a shingle
  hash is the least within SPREAD neighbouring shingles, so equal text is cut
  alike wherever it stands. A piece is so short that an edit takes it under 0.75;
  its bucket key is the hash of all its words.

In document order, the first paragraph of a cluster stays and the others are
removed; of pieces, only runs that cover at least MIN_WORDS words. Lines go
first: a piece that touches a removed line is never the one that stays. So every
verbatim repeat of 51 words or more loses its later copies (two cuts lie at most
SPREAD - 1 words from its ends), and no text shorter than MIN_WORDS words is
touched.

Texts are shuffled once, to meet the spans to cut. Line sets are made again from
the text where they are needed, behind filters of fixed size.

Defined cases: a null text stays null, an empty one empty; documents without
words lose nothing; rows with equal id and text are one document and get the
same result; documents without an id come last in document order; other columns
are not read. Words, pieces and sets are compared by hashes of 55 bits or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mercato.llm.buckets import blobs, bucket_bits, by_bucket, flushes, meeting, numbers, schema, whole_buckets
from mercato.llm.near import KeyFilter, few, merged_join, near_components, permutations, repeated_filter
from mercato.llm.text import (
    BATCH_ROWS,
    LOWER,
    SET_ROWS,
    SPACED,
    distinct_by_row,
    list_array,
    mix,
    row_sums,
    set_ids,
    small_batches,
    span_hashes,
    split_words,
    text_chunks,
    window_hashes,
    word_span_hashes,
)
from mercato.plans.session import materialize

SHINGLE, LEAST, BANDS = 5, 75, 5
MIN_WORDS, SPREAD = 20, 16

#: Bits of the filter of repeated pieces: one a piece, but at most these (16 MB).
MOST_FILTER_BITS = 1 << 27


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every ``width`` (a power of two) neighbours."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def cuts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions (in all words) of the shingles that are least among SPREAD
    neighbours of their row; windows that reach over a row's end count too."""
    n = np.diff(first)
    n_shingles = np.maximum(n - SHINGLE + 1, 0)
    every = window_hashes(hashes, SHINGLE)
    if not n_shingles.sum():
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(n)), n_shingles)
    at = np.arange(n_shingles.sum()) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    position = first[row] + at
    pad = SPREAD - 1
    spot = np.arange(len(position)) + (row + 1) * pad
    line = np.full(len(position) + (len(n) + 1) * pad, np.iinfo(np.uint64).max, np.uint64)
    line[spot] = every[position]
    low = _sliding(line, SPREAD, np.minimum)
    high = _sliding(low, SPREAD, np.maximum)
    return position[high[spot - pad] == every[position]]


class Chunk:
    """Words, pieces and lines of some rows."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray) -> None:
        low = LOWER[buf]
        self.rows = len(offs) - 1
        self.starts, self.ends, self.first = split_words(low, offs, SPACED)
        self.hashes = span_hashes(low, self.starts, self.ends)
        breaks = np.flatnonzero(buf == 0x0A)
        edges = np.union1d(self.first[:-1], np.searchsorted(self.starts, breaks))
        edges = edges[edges < len(self.starts)]
        self.line_first = np.append(edges, len(self.starts)).astype(np.int64)

    def row_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, side="right") - 1

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, end) in words of all rows."""
        cut = cuts(self.hashes, self.first)
        row = self.row_of(cut)
        same = row[:-1] == row[1:]
        return row[:-1][same], cut[:-1][same], cut[1:][same] + SHINGLE

    def long_lines(self) -> np.ndarray:
        return np.flatnonzero(np.diff(self.line_first) >= MIN_WORDS)

    def line_sets(self, lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(lines, items, first) for groups of long lines."""
        every = window_hashes(self.hashes, SHINGLE)
        for g in range(0, len(lines), SET_ROWS):
            part = lines[g : g + SET_ROWS]
            n = self.line_first[part + 1] - self.line_first[part] - SHINGLE + 1
            owner = np.repeat(np.arange(len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.line_first[part][owner]
            yield part, *distinct_by_row(every[at], owner, len(part))


def _lists(values: np.ndarray, row: np.ndarray, rows: int, width: int = 1) -> pa.Array:
    return list_array(values, np.searchsorted(row, np.arange(rows + 1)) * width)


#: Two cuts next to each other lie at most SPREAD apart, so a byte holds the step
#: from one to the next. Pieces of a row follow each other: from p_first on, each
#: begins a step after the one before and ends SHINGLE words after the next cut.
PARTS = "doc_id long, doc_key long, p_first long, p_hash binary, p_step binary, l_hash array<long>, l_size array<long>, l_start array<long>, l_end array<long>, l_keys array<long>"


def paragraphs_of(docs: DataFrame) -> DataFrame:
    """Per document its pieces (p_; 8 bytes of hash and one of step each) and long
    lines (l_): hashes, word spans, and for lines the set size and BANDS keys each,
    in one list."""
    factors, offsets = permutations(BANDS)
    names = [c.split()[0] for c in PARTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in text_chunks(batch.column(2), most_rows=SET_ROWS):
                chunk, rows = Chunk(buf, offs), hi - lo
                p_row, p_start, p_end = chunk.pieces()
                p_hash = word_span_hashes(chunk.hashes, p_start, p_end)
                p_at = np.searchsorted(p_row, np.arange(rows + 1))
                some = p_at[:-1] < p_at[1:]
                p_first = np.zeros(rows, np.int64)
                p_first[some] = p_start[p_at[:-1][some]] - chunk.first[:-1][some]
                lines = chunk.long_lines()
                l_hash, l_size, l_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, BANDS), np.uint64)]
                for _, items, first in chunk.line_sets(lines):
                    l_hash.append(set_ids(items, first))
                    l_size.append(np.diff(first))
                    least = [np.minimum.reduceat((items + o) * f, first[:-1]) for f, o in zip(factors, offsets)]
                    l_keys.append(np.stack([mix(v + np.uint64(k + 1)) for k, v in enumerate(least)], 1))
                l_row = chunk.row_of(chunk.line_first[lines])
                l_base = chunk.first[l_row]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, rows),
                        batch.column(1).slice(lo, rows),
                        pa.array(p_first),
                        blobs(p_hash, p_at),
                        blobs((p_end - p_start - SHINGLE).astype(np.uint8), p_at),
                        _lists(np.concatenate(l_hash), l_row, rows),
                        _lists(np.concatenate(l_size), l_row, rows),
                        _lists(chunk.line_first[lines] - l_base, l_row, rows),
                        _lists(chunk.line_first[lines + 1] - l_base, l_row, rows),
                        _lists(np.concatenate(l_keys).ravel(), l_row, rows, BANDS),
                    ],
                    names=names,
                )

    return docs.mapInArrow(run, PARTS)


def line_sets_of(docs: DataFrame, keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and items of (at least) these lines, read from the documents with
    these keys."""
    of_docs, of_nodes = KeyFilter(keys), KeyFilter(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.filter(pa.array(of_docs.passes(batch.column(1)))).column(2)
            for _, _, buf, offs in text_chunks(texts, most_rows=SET_ROWS):
                chunk = Chunk(buf, offs)
                for _, items, first in chunk.line_sets(chunk.long_lines()):
                    out = pa.RecordBatch.from_arrays([pa.array(set_ids(items, first)), list_array(items, first)], names=["node", "items"])
                    yield out.filter(pa.array(of_nodes.passes(out.column(0))))

    return docs.mapInArrow(run, "node long, items array<long>")


def _with_first(rows: DataFrame, by: str) -> DataFrame:
    """Rows of groups ``by`` that come after the first of their group, with
    ``first_doc``, the document of that one. What goes always has an earlier place
    that stays, so no two places can name each other."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key", "start")
    places = rows.groupBy(by).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = places.filter("first < last").select(by, "first")
    later = merged_join(rows, first, by).filter(place > F.col("first"))
    return later.select("doc_key", "start", "end", F.col("first.doc_id").alias("first_doc"))


#: Flags of a place: its document has no id; it touches a removed line; the span is
#: a line; the document of the first place has no id.
NO_ID, TOUCHED, LINE, NO_FIRST = 1, 2, 4, 8

PLACES = schema("hash", "doc_id", "doc_key", "start", "words", "flags")
SPANS = schema("doc_key", "start", "end", "first_doc", "flags")


def _in_rows(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places in words, in one order over all rows."""
    return (row.astype(np.int64) << 32) + at


def pieces_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row of the batch, start, words) of the pieces of rows of PARTS."""
    hashes, at = numbers(batch.column("p_hash"), "<u8")
    steps = numbers(batch.column("p_step"), "u1")[0].astype(np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    past = np.cumsum(steps) - steps
    first = batch.column("p_first").to_numpy()
    return hashes, row, first[row] + past - past[at[row]], steps + SHINGLE


def _places(columns: list[np.ndarray], bits: int) -> pa.RecordBatch:
    order = np.argsort(columns[0])
    columns = [c[order] for c in columns]
    return by_bucket(columns[0], bits, dict(zip(("hash", "doc_id", "doc_key", "start", "words", "flags"), columns)))


def _spans(doc_key: np.ndarray, start: np.ndarray, end: np.ndarray, first_doc: np.ndarray, flags: np.ndarray, bits: int) -> pa.RecordBatch:
    key = doc_key.view(np.uint64)
    order = np.argsort(key)
    columns = {"doc_key": doc_key, "start": start.astype(np.int32), "end": end.astype(np.int32), "first_doc": first_doc, "flags": flags.astype(np.uint8)}
    return by_bucket(key[order], bits, {k: c[order] for k, c in columns.items()})


def _later(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(doc_key, start, end, first_doc, flags) of the places that come after the
    first one of their hash that touches no removed line."""
    hashes, doc_id, doc_key, start, words, flags = (
        numbers(table[c], t)[0] for c, t in (("hash", "<u8"), ("doc_id", "<i8"), ("doc_key", "<i8"), ("start", "<i4"), ("words", "u1"), ("flags", "u1"))
    )
    order = np.lexsort((start, doc_key, doc_id, flags & NO_ID, hashes))
    hashes, doc_id, doc_key, start, words, flags = (c[order] for c in (hashes, doc_id, doc_key, start, words, flags))
    fresh = np.ones(len(hashes), bool)  # rows of equal id and text are one document
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc_key[1:] != doc_key[:-1]) | (start[1:] != start[:-1])
    hashes, doc_id, doc_key, start, words, flags = (c[fresh] for c in (hashes, doc_id, doc_key, start, words, flags))
    at = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    place, n = np.arange(len(hashes)), len(hashes)
    first = np.minimum.reduceat(np.where(flags & TOUCHED, n, place), at)
    first = np.repeat(first, np.diff(np.append(at, n)))
    later = place > first
    first = first[later]
    no_first = np.where(flags[first] & NO_ID, NO_FIRST, 0)
    return doc_key[later], start[later], start[later] + words[later], doc_id[first], no_first


def repeated_pieces(parts: DataFrame, gone: DataFrame, n_pieces: int) -> DataFrame:
    """Later occurrences of pieces, as SPANS by document. The first one is chosen
    among those that touch no removed line (``gone``: doc_key, start, end)."""
    bits = bucket_bits(n_pieces)
    lines = gone.groupBy("doc_key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("gone"))
    known = repeated_filter(parts.select("p_hash"), lambda batch: numbers(batch.column(0), "<u8")[0], n_pieces, MOST_FILTER_BITS)
    of_gone = KeyFilter(gone.select("doc_key"))

    def places(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            if not cut:
                batch = batch.filter(pa.array(~of_gone.passes(batch.column(1))))
            hashes, row, start, words = pieces_of(batch)
            ok = np.flatnonzero(known.passes(pa.array(hashes.view(np.int64))))
            hashes, row, start, words = hashes[ok], row[ok], start[ok], words[ok]
            ids = batch.column(0)
            flags = np.where(ids.is_null().to_numpy(zero_copy_only=False), NO_ID, 0).astype(np.uint8)[row]
            if cut:
                # lines of a document lie apart, so the last that begins before a piece's end tells
                cuts_of, inner = batch.column("gone"), batch.column("gone").flatten()
                line_row = pc.list_parent_indices(cuts_of).to_numpy()
                begins = np.append(_in_rows(line_row, inner.field(0).to_numpy()), np.iinfo(np.int64).max)
                ends = np.append(_in_rows(line_row, inner.field(1).to_numpy()), 0)
                before = np.searchsorted(begins, _in_rows(row, start + words)) - 1
                flags[(before >= 0) & (ends[before] > _in_rows(row, start))] |= TOUCHED
            key = batch.column(1).to_numpy()
            yield [hashes, ids.fill_null(0).to_numpy()[row], key[row], start.astype(np.int32), words.astype(np.uint8), flags]

    def dealt(cut: bool):
        return lambda batches: (_places(columns, bits) for columns in flushes(places(batches, cut)))

    def of_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(of_gone.passes(batch.column(1))))

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in flushes(_later(table) for table in whole_buckets(batches)):
            yield _spans(*columns, bits)

    names = ["doc_id", "doc_key", "p_first", "p_hash", "p_step"]
    rows = parts.select(*names)
    maybe = merged_join(rows.mapInArrow(of_cut, rows.schema), lines, "doc_key", "left").select(*names, F.coalesce("gone", F.expr("array()")).alias("gone"))
    found = maybe.mapInArrow(dealt(True), PLACES).unionByName(rows.mapInArrow(dealt(False), PLACES))
    return meeting(found, n_pieces).mapInArrow(later, SPANS)


def _line_spans(lines: DataFrame, n_pieces: int) -> DataFrame:
    """Later lines as SPANS by document."""
    bits = bucket_bits(n_pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, start, end, first = (batch.column(i) for i in range(4))
                flags = np.where(first.is_null().to_numpy(zero_copy_only=False), LINE | NO_FIRST, LINE)
                yield _spans(key.to_numpy(), start.to_numpy(), end.to_numpy(), first.fill_null(0).to_numpy(), flags, bits)

    return lines.select("doc_key", "start", "end", "first_doc").mapInArrow(run, SPANS)


def repeated_lines(parts: DataFrame, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Later lines of every cluster: doc_key, start, end, first_doc."""
    zipped = F.arrays_zip(
        F.col("l_hash").alias("node"), F.col("l_size").alias("size"), F.col("l_start").alias("start"), F.col("l_end").alias("end")
    )
    lines = parts.select("doc_key", F.posexplode(zipped).alias("k", "l"), "l_keys").select(
        "doc_key", "l.*", F.slice("l_keys", F.col("k") * BANDS + 1, BANDS).alias("keys")
    )
    distinct = lines.groupBy("node", "size", "keys").agg(F.min("doc_key").alias("doc_key"), F.count("*").alias("n"))
    n_lines = parts.select(F.sum(F.size("l_hash"))).first()[0] or 0
    distinct = materialize(few(distinct, n_lines))

    def sets_of(wanted: DataFrame) -> DataFrame:
        of = materialize(few(merged_join(wanted, distinct.select("node", "doc_key"), "node"), n_lines))
        return line_sets_of(docs, of.select("doc_key"), of.select("node")).dropDuplicates(["node"])

    # sets of lines are hardly longer than a sketch
    roots = near_components(distinct.select("node", "size", "keys"), sets_of, least, sketch=False)
    # all others are alone in their cluster
    met = KeyFilter(distinct.filter("n > 1").select("node").unionByName(roots.select("node")))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(2)
            row, ok = pc.list_parent_indices(nodes), pa.array(met.passes(nodes.flatten()))
            flat = [batch.column(i).take(row).filter(ok) for i in (0, 1)] + [batch.column(i).flatten().filter(ok) for i in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays(flat, names=["doc_id", "doc_key", "node", "start", "end"])

    found = parts.select("doc_id", "doc_key", "l_hash", "l_start", "l_end")
    found = found.mapInArrow(places, "doc_id long, doc_key long, node long, start long, end long")
    placed = merged_join(found, roots, "node", "left")
    return _with_first(placed.withColumn("root", F.coalesce("root", "node")), "root")


def _runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans (places of ``_in_rows``) that touch or overlap joined to one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    at = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]][: len(start)])
    return start[at], reach[np.append(at[1:], len(start)) - 1] if len(at) else reach


REMOVED = "doc_key long, starts array<long>, ends array<long>, first_docs array<long>"


def _removed(table: pa.Table, least: int) -> pa.RecordBatch:
    """Per document what goes: lines, and runs of pieces that cover ``least`` words;
    and the documents where it stays."""
    doc_key, start, end, first_doc, flags = (
        numbers(table[c], t)[0] for c, t in (("doc_key", "<i8"), ("start", "<i4"), ("end", "<i4"), ("first_doc", "<i8"), ("flags", "u1"))
    )
    docs, row = np.unique(doc_key, return_inverse=True)
    start, end, line = _in_rows(row, start), _in_rows(row, end), (flags & LINE) > 0
    run_start, run_end = _runs(start[~line], end[~line])
    long = run_end - run_start >= least
    run_start, run_end = _runs(np.r_[run_start[long], start[line]], np.r_[run_end[long], end[line]])
    run_row, some = np.unique(run_start >> 32, return_inverse=True)
    run = np.searchsorted(run_start, start, side="right") - 1
    inside = (run >= 0) & (end <= np.append(run_end, 0)[run]) & (flags & NO_FIRST == 0)
    pairs = np.unique(np.stack([row[inside], first_doc[inside]], 1), axis=0)
    run_first, doc_first = np.searchsorted(some, np.arange(len(run_row) + 1)), np.searchsorted(pairs[:, 0], np.append(run_row, len(docs)))
    words = (1 << 32) - 1
    lists = [(run_start & words, run_first), (run_end & words, run_first), (pairs[:, 1], doc_first)]
    columns = [pa.ListArray.from_arrays(pa.array(f.astype(np.int32)), pa.array(v.astype(np.int64))) for v, f in lists]
    return pa.RecordBatch.from_arrays([pa.array(docs[run_row]), *columns], names=["doc_key", "starts", "ends", "first_docs"])


def removed_spans(spans: DataFrame, n: int, least: int = MIN_WORDS) -> DataFrame:
    """REMOVED of the documents that lose something, from SPANS (``n`` at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            out = _removed(table, least)
            for lo in range(0, out.num_rows, BATCH_ROWS):
                yield out.slice(lo, BATCH_ROWS)

    return meeting(spans, n).mapInArrow(run, REMOVED)


def _kept(raw: bytes, starts: np.ndarray, ends: np.ndarray, removed: Iterator[tuple[int, int]]) -> bytes:
    """The text without the words of these spans; ``starts`` and ``ends`` are the
    bytes of its words. A line that is removed whole goes with its line break."""
    out, at = [], 0
    for s, e in removed:
        lo, hi = int(starts[s]), int(ends[e - 1])
        heads = b"\n" in raw[int(ends[s - 1]) : lo] if s else True
        tails = b"\n" in raw[hi : int(starts[e])] if e < len(starts) else True
        if tails and heads:
            hi = raw.find(b"\n", hi) + 1 or len(raw)
        elif not tails:
            hi = int(starts[e])
        out.append(raw[at:lo])
        at = max(at, hi)
    out.append(raw[at:])
    return b"".join(out)


def cut_texts(texts: pa.Array, removed: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts without the words of their spans (lists of start, end), and the
    number of words before."""
    new, n_words = [], [np.zeros(0, np.int64)]
    for lo, hi, buf, offs in text_chunks(texts):
        starts, ends, first = split_words(buf, offs, SPACED)
        n_words.append(np.diff(first))
        raw = buf.tobytes()
        for i, spans in enumerate(removed.slice(lo, hi - lo).to_pylist()):
            text, a, b = raw[offs[i] : offs[i + 1]], first[i], first[i + 1]
            if spans:
                text = _kept(text, starts[a:b] - offs[i], ends[a:b] - offs[i], [(s["start"], s["end"]) for s in spans])
            new.append(text)
    none = texts.is_null().to_pylist()
    return pa.array([None if x else t for t, x in zip(new, none)], pa.binary()).cast(pa.string()), np.concatenate(n_words)


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("doc_key"), text.alias("text"))


def dedup_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, text (without the removed passages), n_words
    (before), n_removed (words), removed (word spans: start, end), first_docs
    (documents where the removed passages stay), and the ``keep`` columns of
    docs as a struct ``row``."""
    small_batches(docs.sparkSession)
    rows = with_key(docs, id_col, text_col)
    seen = Observation()
    parts = materialize(paragraphs_of(rows).observe(seen, F.sum(F.octet_length("p_step")).alias("n")))
    n_pieces = int(seen.get["n"] or 0)
    lines = materialize(repeated_lines(parts, rows))
    pieces = repeated_pieces(parts, lines.select("doc_key", "start", "end"), n_pieces)
    by_doc = removed_spans(pieces.unionByName(_line_spans(lines, n_pieces)), n_pieces)
    whole = rows
    if keep:
        doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
        whole = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("doc_key"), text.alias("text"), F.struct(*keep).alias("row"))
    extra = f", row {whole.schema['row'].dataType.simpleString()}" if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = batch.column("starts"), batch.column("ends")
            spans = pa.StructArray.from_arrays([starts.flatten(), ends.flatten()], names=["start", "end"])
            first = np.cumsum(np.r_[0, starts.value_lengths().to_numpy(zero_copy_only=False)])
            removed = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), spans)
            texts, n_words = cut_texts(batch.column("text"), removed)
            n_removed = row_sums(ends.flatten().to_numpy() - starts.flatten().to_numpy(), first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    texts,
                    pa.array(n_words),
                    pa.array(n_removed),
                    removed,
                    batch.column("first_docs"),
                    *([batch.column("row")] if keep else []),
                ],
                names=["doc_id", "text", "n_words", "n_removed", "removed", "first_docs", *(["row"] if keep else [])],
            )

    joined = merged_join(whole, by_doc, "doc_key", "left")
    found = [F.coalesce(c, F.expr("cast(array() as array<bigint>)")).alias(c) for c in ("starts", "ends", "first_docs")]
    return joined.select(*whole.columns, *found).mapInArrow(
        run,
        "doc_id long, text string, n_words long, n_removed long, removed array<struct<start:long,end:long>>, "
        f"first_docs array<long>{extra}",
    )
