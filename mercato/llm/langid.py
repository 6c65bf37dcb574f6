"""Language identification in two steps: family, then language in the family.

Texts become relative frequencies of hashed byte trigrams of their lower-cased
words, with a space before and after the text. One-versus-rest linear support vector machines choose the language
family; within a family, one-versus-one machines separate its languages, and
the language with the most confidence over its duels wins.

The machines are fitted on a bounded sample of the labelled rows
(``sample_rows``, those with the smallest hash of their id); prediction reads
every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
with no labelled row everything is ``und``; a single learned language is always
predicted with score 1; rows with a null language are not learned from;
repeated rows are predicted alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import ALNUM, split_words, text_chunks

DIMENSIONS = 4096
SAMPLE_ROWS = 2000
UNKNOWN = "und"

# Families of related languages; a language not listed is a
# family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


#: Bytes of letters: everything else is a word boundary here.
_LETTERS = ALNUM.copy()
_LETTERS[0x30:0x3A] = False


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def histograms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, relative trigram frequencies) of runs of rows."""
    for lo, hi, buf, offs in text_chunks(pc.utf8_lower(texts.cast(pa.large_string())), most_rows=256):
        rows = hi - lo
        # a space on both sides of every text, so that each letter is the middle of a trigram
        low = np.full(len(buf) + 2 * rows, 0x20, np.uint32)
        owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offs) + 2)
        low[np.arange(len(buf)) + 2 * np.repeat(np.arange(rows), np.diff(offs)) + 1] = np.where(_LETTERS[buf], buf, np.uint8(0x20))
        three = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        keep = (owner[:-2] == owner[2:]) & (low[1:-1] != 0x20)
        slot = ((three * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        h = np.bincount((owner[:-2] * DIMENSIONS + slot)[keep], minlength=rows * DIMENSIONS).reshape(rows, -1).astype(float)
        total = h.sum(axis=1, keepdims=True)
        yield lo, hi, h / np.maximum(total, 1)


@dataclass
class Machine:
    """Linear support vector machine: positive means ``yes``."""

    yes: str
    no: str
    weights: np.ndarray
    bias: float


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Squared hinge with an L2 penalty, by accelerated gradient descent; the
    two classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost
    w = v = np.zeros(x.shape[1])
    curvature = 1 + 2 * (weight[:, None] * x * x).sum()
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = v - 2 * x.T @ (weight * y * slack)
        w, last = v - grad / curvature, w
        v = w + k / (k + 3) * (w - last)
    return w[:-1], float(w[-1])


@dataclass
class Model:
    scale: np.ndarray
    families: dict[str, list[str]] = field(default_factory=dict)
    by_family: list[Machine] = field(default_factory=list)
    duels: dict[str, list[Machine]] = field(default_factory=dict)

    def predict(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score in 0..1 of every histogram."""
        n, x = len(h), h * self.scale
        names = list(self.families)
        if not names:
            return np.full(n, UNKNOWN, object), np.zeros(n)
        margin = np.zeros((n, len(names)))
        for k, m in enumerate(self.by_family):
            margin[:, k] = x @ m.weights + m.bias
        share = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        chosen = share.argmax(axis=1)
        lang, score = np.full(n, UNKNOWN, object), share[np.arange(n), chosen]
        for k, name in enumerate(names):
            rows = np.flatnonzero(chosen == k)
            langs = self.families[name]
            votes = np.ones((len(rows), len(langs))) if len(langs) == 1 else np.zeros((len(rows), len(langs)))
            for m in self.duels[name]:
                p = 1 / (1 + np.exp(-4 * np.clip(x[rows] @ m.weights + m.bias, -20, 20)))
                votes[:, langs.index(m.yes)] += p / (len(langs) - 1)
                votes[:, langs.index(m.no)] += (1 - p) / (len(langs) - 1)
            best = votes.argmax(axis=1)
            lang[rows] = np.asarray(langs, object)[best]
            score[rows] *= votes[np.arange(len(rows)), best]
        return lang, np.clip(score, 0, 1)


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on at most ``sample_rows`` rows that have a language and a letter."""
    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("at"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).filter("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h in histograms(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([r.astype("<f4").tobytes() for r in h], pa.binary())],
                    names=["lang", "h"],
                )

    # the sample's last hash is found on the hashes alone, so no text is sorted or moved
    smallest = rows.select("at").orderBy("at").limit(sample_rows)
    last = smallest.agg(F.max("at")).first()[0]
    sample = rows.filter(F.col("at") <= (0 if last is None else last)).select("lang", "text").mapInArrow(run, "lang string, h binary")
    got = sample.limit(2 * sample_rows).collect()  # rows of DIMENSIONS * 4 bytes; more than sample_rows only by equal ids
    h = np.stack([np.frombuffer(r.h, "<f4") for r in got]).astype(float) if got else np.zeros((0, DIMENSIONS))
    langs = np.asarray([r.lang for r in got], object)
    some = h.sum(axis=1) > 0
    h, langs = h[some], langs[some]
    model = Model(1 / np.sqrt(h.mean(axis=0) + 1e-4) if len(h) else np.ones(DIMENSIONS))
    x = h * model.scale
    for lang in sorted(set(langs)):
        model.families.setdefault(family_of(lang), []).append(lang)
    family = np.asarray([family_of(v) for v in langs], object)
    for name, members in model.families.items():
        if len(model.families) > 1:
            model.by_family.append(Machine(name, "", *fit_machine(x, np.where(family == name, 1.0, -1.0))))
        model.duels[name] = []
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                of = (langs == a) | (langs == b)
                model.duels[name].append(Machine(a, b, *fit_machine(x[of], np.where(langs[of] == a, 1.0, -1.0))))
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for lo, hi, h in histograms(texts):
                lang, score = model.predict(h)
                for i in range(hi - lo):
                    if not _has_letter(texts[lo + i].as_py()):
                        lang[i], score[i] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(list(lang), pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(id_col: str, parts: int) -> Column:
    """Deterministic fold of a row: crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))
