"""Fill-in-the-middle documents, cut through a learned rank index.

A text is cut into units (lines with their break; the last may lack it), and the
rank of a unit boundary among all boundaries, 0 to n, names a place to cut. Where
boundary ``r`` lies is answered by an index fitted to the offsets of all
boundaries of the text: segments of a piecewise-linear function that is off by at
most ERROR bytes anywhere, found by narrowing a cone of slopes in one pass, and
one stored residual per boundary, which makes every answer exact. A residual
fits in one byte, where an offset would take eight.

The two cuts of a document are drawn from a hash of its id, so a row's result
depends on the row alone: nothing is shuffled, a lost task repeats its own rows,
and a task holds one Arrow batch. Offsets are found on UTF-8 bytes; a line break
is never part of another character.

Defined cases: a null text is an empty one; an empty text, and one that holds a
marker of its own, is left plain; a null id hashes as an empty one; repeated rows
get the same result; rows without a text column of type string are cast; columns
other than the id and the text are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Greatest distance in bytes between a prediction and its boundary.
ERROR = 127
#: Share of documents, in percent, that are transformed, and of those the share
#: that gets the suffix first.
TRANSFORMED, SUFFIX_FIRST = 100, 50
SEED = 7
#: Rows whose results a task holds at once.
ROWS = 64


class RankIndex:
    """Offsets of unit boundaries by rank: error-bounded segments and residuals.

    ``first`` holds the first rank of each segment, ``base`` the offset there and
    ``slope`` the rise per rank (in 2**-SHIFT bytes); ``residual`` the difference
    between every boundary and its prediction.
    """

    SHIFT = 16

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        self.error = error
        first, slope = self._segments(offsets.tolist())
        self.first = np.asarray(first, np.int64)
        self.base = offsets[self.first]
        self.slope = np.asarray(slope, np.int64)
        ranks = np.arange(len(offsets))
        of = np.searchsorted(self.first, ranks, side="right") - 1
        self.residual = (offsets - self._line(of, ranks)).astype(np.int16 if error > 127 else np.int8)

    def _segments(self, offsets: list[int]) -> tuple[list[int], list[int]]:
        """Greedy: a segment goes on as long as one slope from its first point
        stays within the error of every later point."""
        shift, room = self.SHIFT, (self.error - 1) << self.SHIFT  # one byte for rounding down
        first, slope = [0], []
        start = at = 0
        low, high = 0, 1 << 62
        for rank in range(1, len(offsets)):
            run, rise = rank - start, (offsets[rank] - at) << shift
            least, most = -((room - rise) // run), (rise + room) // run
            if least > high or most < low:
                slope.append((low + high) >> 1 if high < 1 << 62 else low)
                first.append(rank)
                start, at, low, high = rank, offsets[rank], 0, 1 << 62
            else:
                low, high = max(low, least), min(high, most)
        slope.append((low + high) >> 1 if high < 1 << 62 else low)
        return first, slope

    def _line(self, segment, rank):
        return self.base[segment] + (((rank - self.first[segment]) * self.slope[segment]) >> self.SHIFT)

    def predict(self, rank: int) -> int:
        return int(self._line(int(np.searchsorted(self.first, rank, side="right")) - 1, rank))

    def offset(self, rank: int) -> int:
        """Exact offset of boundary ``rank``."""
        return self.predict(rank) + int(self.residual[rank])


def boundaries(text: bytes) -> np.ndarray:
    """Offsets of all unit boundaries, 0 and the text's length included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    edges = np.concatenate([[0], ends]).astype(np.int64)
    return edges if edges[-1] == len(text) else np.append(edges, len(text))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The first four 32-bit numbers of the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def arranged(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == PSM:
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restored(form: str, output: bytes) -> bytes:
    """The text that ``output`` was made of."""
    if form == PLAIN:
        return output
    head, middle = output.split(MIDDLE)
    if form == PSM:
        prefix, suffix = head[len(PREFIX) :].split(SUFFIX)
    else:
        suffix, prefix = head[len(SUFFIX) :].split(PREFIX)
    return prefix + middle + suffix


def _chars(text: bytes) -> int:
    return len(text.decode())


OUTPUT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
    "n_segments long, largest_residual long, text string"
)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n (units), form (plain, psm or spm), prefix_chars and
    middle_chars (null if plain), output, n_segments and largest_residual of its
    index, and text (rebuilt from output and form)."""
    names = [c.split()[0] for c in OUTPUT.split(", ")]

    def transform(doc_id: int | None, text: bytes) -> tuple:
        edges = boundaries(text)
        n = len(edges) - 1
        index = RankIndex(edges)
        one, two, share, order = draws(doc_id, seed)
        shape = (len(index.first), int(np.abs(index.residual.astype(np.int64)).max()))
        if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or share % 100 >= TRANSFORMED:
            return (n, PLAIN, None, None, text, *shape)
        lo, hi = (index.offset(r) for r in sorted((one % (n + 1), two % (n + 1))))
        form = SPM if order % 100 < SUFFIX_FIRST else PSM
        output = arranged(form, text[:lo], text[lo:hi], text[hi:])
        return (n, form, _chars(text[:lo]), _chars(text[lo:hi]), output, *shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                ids = batch.column(0).slice(lo, ROWS)
                texts = batch.column(1).slice(lo, ROWS).cast(pa.binary()).to_pylist()
                rows = [transform(i, t or b"") for i, t in zip(ids.to_pylist(), texts)]
                n, form, before, inside, output, segments, largest = zip(*rows)
                back = [restored(f, o) for f, o in zip(form, output)]
                long, text = pa.int64(), lambda values: pa.array(values, pa.large_binary()).cast(pa.large_string())
                columns = [ids, pa.array(n, long), pa.array(form), pa.array(before, long), pa.array(inside, long)]
                columns += [text(output), pa.array(segments, long), pa.array(largest, long), text(back)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(run, OUTPUT)
