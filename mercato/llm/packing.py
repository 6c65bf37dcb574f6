"""Packing documents into fixed windows: best-fit decreasing.

Each task takes the documents of its partition in blocks of bounded size,
cuts overlong ones into full windows, sorts what is left by decreasing length
and puts every piece into the open window with the least room that still holds
it. A segment tree over the remaining capacities finds that window. Blocks are
independent, so nothing is shuffled, memory is bounded by the block, and a lost
task repeats only its own partition (file scans give a partition the same rows
again).

Defined cases: a null text is empty and still has its end id; an empty table
gives no row; repeated rows are separate documents; a null id is kept as it is;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import small_batches

WINDOW = 4096
END_ID = 2
#: Ids a task holds before it packs them; about this many / WINDOW windows.
BLOCK_TOKENS = 4_000_000
#: Bytes of words and ids a task remembers in each of two generations, and as
#: much again for parts of words; only speed depends on it.
REMEMBERED_BYTES = 40 << 20
#: What an entry takes beside the characters of its key and its ids.
ENTRY_BYTES = 200

PIECE_SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class Capacities:
    """Segment tree over remaining capacities 0..size: which have open windows."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.tree = [0] * (2 * self.leaves)

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        if capacity:
            self.open[capacity].append(window)
            self._add(capacity, 1)

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need with an open window."""
        node = need + self.leaves
        if self.tree[node]:
            return need
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], size: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document index, start, length, window, offset) for all lengths.

    Ties in length go by document index, so the result is deterministic.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    rest: list[tuple[int, int, int]] = []
    windows = 0
    for i, n in enumerate(lengths):
        full = n // size
        for k in range(full):
            pieces.append((i, k * size, size, windows, 0))
            windows += 1
        if n - full * size:
            rest.append((n - full * size, i, full * size))
    rest.sort(key=lambda r: (-r[0], r[1]))
    rooms = Capacities(size)
    for n, i, start in rest:
        room = rooms.tightest(n)
        if room is None:
            window, room = windows, size
            windows += 1
        else:
            window = rooms.take(room)
        pieces.append((i, start, n, window, size - room))
        rooms.put(room - n, window)
    return pieces


#: Parts whose boundaries are also boundaries of the tokenizer's own first split.
_PARTS = re.compile(r"[^\W\d_]+|\d+|(?:_|[^\w \t\n\r])+")
_SPACES = re.compile("[\n\t\r]")


class Remembered:
    """Ids by text in two generations of bounded size: when the young one is full
    it becomes the old one, so what keeps coming back stays known."""

    def __init__(self, most: int = REMEMBERED_BYTES) -> None:
        self.most, self.held = most, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def unknown(self, keys: set[str]) -> list[str]:
        """Those in neither generation; the others are in the young one after this."""
        missing = []
        for key in keys.difference(self.young):
            found = self.old.get(key)
            if found is None:
                missing.append(key)
            else:
                self.put(key, found)
        return missing

    def put(self, key: str, ids: bytes) -> None:
        self.young[key] = ids
        self.held += len(key) + len(ids) + ENTRY_BYTES

    def age(self) -> None:
        """To be called between texts: a full young generation becomes the old one."""
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0


def word_encoder(path: str) -> Callable[[str], bytes]:
    """text -> its ids as little-endian 16-bit integers.

    The vocabulary of this kind lower-cases, drops white space and never merges
    across it or between letters and other characters, so a text's ids are those
    of its parts in a row; the ids of words and parts seen of late are remembered,
    in bounded memory that goes with the encoder.
    Words where lower-casing first could matter (characters that are not
    composed, a capital sigma) and words with apostrophes are not cut.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
        raise ValueError("ids beyond 16 bits")
    words, parts = Remembered(), Remembered()
    # The printable byte signs of byte-level vocabularies: bytes that are not
    # printable in Latin-1 stand for the characters from 256 on, in order.
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte_signs = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def plain(text: str) -> bool:
        """Whether lower-casing and cutting first can't change the ids."""
        if "'" in text or "\u03a3" in text or any(x in text for x in specials):
            return False
        return text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", text.lower()))

    def ids_of(part: str) -> bytes:
        if part.isalpha():  # one run of letters: the merges alone decide
            coded = part if part.isascii() else part.encode().decode("latin-1").translate(byte_signs)
            return array("H", [t.id for t in tokenizer.model.tokenize(coded)]).tobytes()
        return array("H", tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def learn(missing: list[str], cut: bool) -> None:
        whole, split = [], []
        for w in missing:
            (split if cut or plain(w) else whole).append(w)
        for w in whole:
            words.put(w, array("H", tokenizer.encode(w, add_special_tokens=False).ids).tobytes())
        found = [_PARTS.findall(w.lower()) for w in split]
        for p in parts.unknown({p for ps in found for p in ps}):
            parts.put(p, ids_of(p))
        known = parts.young
        for w, ps in zip(split, found):
            words.put(w, known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]))

    def encode(text: str) -> bytes:
        row = _SPACES.sub(" ", text).split(" ")
        try:
            return b"".join([words.young[w] for w in row])
        except KeyError:
            pass
        words.age()
        parts.age()
        learn(words.unknown(set(row)), plain(text))
        return b"".join([words.young[w] for w in row])

    return encode


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset
    and ids (little-endian unsigned 32-bit integers)."""
    end = np.asarray([end_id], dtype="<u2").tobytes()
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
        + [("ids", pa.binary())]
    )

    def pack_block(doc_ids: list, ids: list[bytes], first_sequence: int) -> Iterator[pa.RecordBatch]:
        lengths = [len(b) // 2 for b in ids]
        pieces = best_fit_decreasing(lengths, window)
        for lo in range(0, len(pieces), 2000):
            part = pieces[lo : lo + 2000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[p[0]] for p in part], pa.int64()),
                    pa.array([p[1] for p in part], pa.int64()),
                    pa.array([p[2] for p in part], pa.int64()),
                    pa.array([lengths[p[0]] for p in part], pa.int64()),
                    pa.array([first_sequence + p[3] for p in part], pa.int64()),
                    pa.array([p[4] for p in part], pa.int64()),
                    pa.array(
                        [
                            np.frombuffer(ids[p[0]], "<u2", p[2], 2 * p[1]).astype("<u4").tobytes()
                            for p in part
                        ],
                        pa.binary(),
                    ),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 33
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                coded = encode(text.as_py() or "") + end
                doc_ids.append(doc_id)
                ids.append(coded)
                held += len(coded) // 2
                if held >= block_tokens:
                    yield from pack_block(doc_ids, ids, sequence)
                    sequence += held  # more than the windows of the block
                    doc_ids, ids, held = [], [], 0
        if ids:
            yield from pack_block(doc_ids, ids, sequence)

    small_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(run, PIECE_SCHEMA)
