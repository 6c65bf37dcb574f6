"""Quality scores by regularised quadratic discriminant analysis.

A document becomes a few transformed statistics of its whole text. Each class
(labels 0 and 1) is a Gaussian whose covariance is shrunk towards the covariance
within the classes and towards its diagonal. A score is the logistic of the
difference of the two log densities plus the log prior; the Mahalanobis
distances use Cholesky factors computed once per model and cached in it.

The class moments (counts, sums, products) are summed by Spark over all labelled
rows; only those sums, whose size does not grow with the data, reach the driver.

Defined cases: a null text counts as empty and is scored; with one class or
none in the labels, scores are the share of label 1 (0.5 with no label); several
labels of a document count with their mean rounded down; null labels or ids are
not learned from; repeated rows get the same score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.near import merged_join
from mercato.llm.text import SPACED, row_windows, small_batches, span_hashes, split_words, text_chunks

NAMES = (
    "log_chars", "log_words", "word_length", "upper", "digit", "symbol", "bang", "bar", "stop",
    "plain_words", "distinct_words", "repeated_windows", "repeated_lines", "beyond_ascii",
)

# Classes of ASCII characters.
_UPPER, _LOWER, _DIGIT, _SPACE, _SYMBOL, _BANG, _BAR, _STOP, _OTHER, _LEAD, _TRAIL = range(11)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[0x41:0x5B], _KINDS[0x61:0x7B], _KINDS[0x30:0x3A] = _UPPER, _LOWER, _DIGIT
_KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KINDS[[ord(c) for c in "#*$%&<>"]] = _SYMBOL
_KINDS[ord("!")], _KINDS[ord("|")] = _BANG, _BAR
_KINDS[[ord(c) for c in ".,;:?"]] = _STOP
_KINDS[0x80:0xC0], _KINDS[0xC0:] = _TRAIL, _LEAD

SHRINK_POOLED, SHRINK_DIAGONAL, FLOOR = 0.2, 0.1, 1e-4


def _distinct(keys: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys of each row."""
    if not len(keys):
        return np.zeros(rows)
    both = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    return np.bincount((both[fresh] >> np.uint64(48)).astype(np.int64), minlength=rows)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of NAMES per text."""
    out = [np.zeros((0, len(NAMES)))]
    for lo, hi, buf, offs in text_chunks(texts, most_rows=1 << 14):
        rows = hi - lo
        owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offs))
        kinds = np.bincount(owner * 16 + _KINDS[buf], minlength=rows * 16).reshape(rows, 16).astype(float)
        starts, ends, first = split_words(buf, offs, SPACED)
        n_words = np.diff(first).astype(float)
        word_of = np.repeat(np.arange(rows), np.diff(first))
        hashes = span_hashes(buf, starts, ends)
        # words of letters only, but for one closing mark
        letters = np.concatenate([[0], np.cumsum(np.isin(_KINDS[buf], (_UPPER, _LOWER, _LEAD, _TRAIL)))])
        inside = letters[ends] - letters[starts]
        plain = np.bincount(word_of[ends - starts - inside <= 1], minlength=rows)
        windows, window_of = row_windows(hashes, first, 5)
        all_windows = np.bincount(window_of, minlength=rows)
        breaks = np.ones(256, bool)
        breaks[0x0A] = False
        l_starts, l_ends, l_first = split_words(buf, offs, breaks)
        line_of = np.repeat(np.arange(rows), np.diff(l_first))
        lines = np.bincount(line_of, minlength=rows)
        chars = kinds.sum(axis=1) - kinds[:, _TRAIL]
        solid = np.maximum(chars - kinds[:, _SPACE], 1)
        some = np.maximum(n_words, 1)
        out.append(
            np.stack(
                [
                    np.log1p(chars),
                    np.log1p(n_words),
                    np.log1p(solid / some),
                    *(np.sqrt(kinds[:, k] / solid) for k in (_UPPER, _DIGIT, _SYMBOL)),
                    *(np.sqrt(kinds[:, k] / some) for k in (_BANG, _BAR, _STOP)),
                    plain / some,
                    _distinct(hashes, word_of, rows) / some,
                    1 - _distinct(windows, window_of, rows) / np.maximum(all_windows, 1),
                    1 - _distinct(span_hashes(buf, l_starts, l_ends), line_of, rows) / np.maximum(lines, 1),
                    np.sqrt(kinds[:, _LEAD] / solid),
                ],
                axis=1,
            )
        )
    return np.concatenate(out)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``x``, the statistics of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(statistics(batch.column(1))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    return wanted.mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Gaussian:
    mean: np.ndarray
    cholesky: np.ndarray
    log_scale: float

    @classmethod
    def of(cls, mean: np.ndarray, cov: np.ndarray) -> "Gaussian":
        lower = np.linalg.cholesky(cov)
        return cls(mean, np.linalg.inv(lower), 2 * float(np.log(np.diag(lower)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.cholesky.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_scale)


@dataclass
class Model:
    prior: float
    low: Gaussian | None = None
    high: Gaussian | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(x), self.prior)
        d = self.high.log_density(x) - self.low.log_density(x) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(d, -500, 500)))


def fit(rows: DataFrame) -> Model:
    """Fit on (x, label) rows, label 0 or 1."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if not batch.num_rows:
                continue
            label = np.asarray(batch.column(1).to_pylist())
            x = np.asarray(batch.column(0).flatten()).reshape(-1, d)
            for k in (0, 1):
                mine = x[label == k]
                total[k] += np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()), pa.array(list(range(total.shape[1])) * 2, pa.int32()), pa.array(total.ravel())],
            names=["label", "at", "v"],
        )

    sums = rows.select("x", F.col("label").cast("int")).mapInArrow(run, "label int, at int, v double")
    total = np.zeros((2, 1 + d + d * d))
    for r in sums.groupBy("label", "at").agg(F.sum("v").alias("v")).collect():  # 2 (1 + d + d * d) numbers
        total[r.label, r.at] = r.v
    n = total[:, 0]
    if n.min() < 2:
        return Model(float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = total[:, 1 : 1 + d] / n[:, None]
    cov = total[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = np.tensordot(n / n.sum(), cov, 1)
    out = []
    for k in (0, 1):
        c = (1 - SHRINK_POOLED) * cov[k] + SHRINK_POOLED * pooled
        c = (1 - SHRINK_DIAGONAL) * c + SHRINK_DIAGONAL * np.diag(np.diag(c)) + FLOOR * np.eye(d)
        out.append(Gaussian.of(mean[k], (c + c.T) / 2))
    return Model(float(n[1] / n.sum()), *out)


def labelled(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Statistics joined with one label per document.

    Never a broadcast join: behind one, the statistics and what reads these rows
    (``fit``) would run in one stage, where every task holds two Python workers at
    once, and the executor keeps the spare ones with all their memory.
    """
    one = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.floor(F.avg("label")).cast("int").alias("label"))
    )
    return merged_join(stats.filter("doc_id is not null"), one, "doc_id").select("x", "label")


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, 0 to 1, of rows with statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score at least ``least``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics(batch.column(at))) >= least))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
