"""License scan with a positional index of rare template words.

Every licence template is a short run of words. Its postings hold, for each
word, the templates and positions it stands at. The inverse document frequency
of these words is counted over the whole corpus; a file is looked up by its
words that belong to the rarest half of some template. Every such hit votes for
(template, relative position); the words of the template are then compared at
that place and the share of matched frequency weight is the score of the place.
A label is given when the share reaches ``least_share`` and a mandatory key
phrase of the template stands there word for word.

Next to it, the base phrases are searched at every position.

Defined cases: a null text counts as empty; a file without words has no places,
empty labels and score 0; repeated rows give the same row; an empty corpus gives
no row; columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.text import ALNUM, LOWER, span_hashes, split_words, text_chunks

# Phrases of the base scan and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (label, wording, mandatory key phrases; one of them must stand).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "creative commons zero v1 0 universal public domain dedication", ("creative commons zero",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("gnu general public license",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)

LEAST_SHARE = 0.7


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    return span_hashes(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)


class Vocabulary:
    """The words of all templates and base phrases, by hash, checked by bytes."""

    def __init__(self) -> None:
        texts = [*BASE, *(t for _, t, _ in TEMPLATES)]
        self.words = sorted({w.encode() for t in texts for w in t.split()})
        hashes = _hashes(self.words)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.ids = {w: i for i, w in enumerate(self.words)}

    def hits(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word in the text, number in the vocabulary) of all hits."""
        found = span_hashes(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        where = np.flatnonzero(self.hashes[at] == found)
        number = self.number[at[where]]
        same = [buf[starts[i] : ends[i]].tobytes() == self.words[k] for i, k in zip(where, number)]
        return where[same], number[same]


def _word_hits(texts: pa.Array, vocabulary: Vocabulary) -> Iterator[tuple[int, np.ndarray, list[dict[int, int]]]]:
    """(first row, words per row, per row {word index: vocabulary number})."""
    for lo, _, buf, offs in text_chunks(texts):
        low = LOWER[buf]
        starts, ends, first = split_words(low, offs, ALNUM)
        where, number = vocabulary.hits(low, starts, ends)
        cut = np.searchsorted(where, first)
        yield (
            lo,
            np.diff(first),
            [
                dict(zip((where[a:b] - first[i]).tolist(), number[a:b].tolist()))
                for i, (a, b) in enumerate(zip(cut[:-1], cut[1:]))
            ],
        )


def word_weights(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency of every vocabulary word over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, files = Vocabulary(), 0
        seen = np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            files += batch.num_rows
            for _, _, hits in _word_hits(batch.column(0), vocabulary):
                for row in hits:
                    if row:
                        seen[list(set(row.values()))] += 1
        words = ["", *(w.decode() for w in vocabulary.words)]  # "" carries the number of files
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array([files, *seen.tolist()])], names=["word", "n"])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    n = {r.word: r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # the vocabulary
    files = n.pop("", 0)
    return {w: math.log((files + 1) / (k + 0.5)) for w, k in n.items()}


class Index:
    """Positional postings of the templates' words, weighted."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.vocabulary = Vocabulary()
        ids = self.vocabulary.ids
        self.weight = [max(weights.get(w.decode(), 1.0), 0.0) + 1e-9 for w in self.vocabulary.words]
        self.templates = [[ids[w.encode()] for w in text.split()] for _, text, _ in TEMPLATES]
        self.keys = [[[ids[w.encode()] for w in key.split()] for key in keys] for _, _, keys in TEMPLATES]
        self.base = [([ids[w.encode()] for w in phrase.split()], label) for phrase, label in BASE.items()]
        self.rare: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.templates):
            by_weight = sorted(set(words), key=lambda w: (-self.weight[w], w))
            entry = set(by_weight[: (len(by_weight) + 1) // 2])
            for p, w in enumerate(words):
                if w in entry:
                    self.rare[w].append((t, p))

    def base_places(self, row: dict[int, int]) -> list[tuple[int, str]]:
        return sorted(
            (i, label)
            for words, label in self.base
            for i, w in row.items()
            if w == words[0] and all(row.get(i + k) == x for k, x in enumerate(words))
        )

    def places(self, row: dict[int, int]) -> list[tuple[int, str, float, bool]]:
        """(start, label, share, has its key phrase) of every voted place."""
        votes = {(t, i - p) for i, w in row.items() for t, p in self.rare.get(w, ())}
        out = []
        for t, start in sorted(votes):
            words = self.templates[t]
            matched = [row.get(start + p) == w for p, w in enumerate(words)]
            share = sum(self.weight[w] for w, m in zip(words, matched) if m) / sum(self.weight[w] for w in words)
            stands = any(
                all(row.get(start + q + k) == x for k, x in enumerate(key))
                for key in self.keys[t]
                for q in range(len(words) - len(key) + 1)
                if words[q : q + len(key)] == key
            )
            out.append((start, TEMPLATES[t][0], share, stands))
        return out


def scan(
    docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least_share: float = LEAST_SHARE
) -> DataFrame:
    """Per file: doc_id, n_words, base (places of base phrases: start, label),
    found (places of templates: start, label, share) and score, the largest
    share of any voted place."""
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(weights)
        for batch in batches:
            n_words, base, found, score = [], [], [], []
            for _, counts, hits in _word_hits(batch.column(1), index.vocabulary):
                n_words += counts.tolist()
                for row in hits:
                    places = index.places(row) if row else []
                    base.append([{"start": i, "label": x} for i, x in index.base_places(row)] if row else [])
                    found.append([{"start": i, "label": x, "share": s} for i, x, s, k in places if k and s >= least_share])
                    score.append(min(1.0, max((s for _, _, s, _ in places), default=0.0)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(base, base_type),
                    pa.array(found, found_type),
                    pa.array(score, pa.float64()),
                ],
                names=["doc_id", "n_words", "base", "found", "score"],
            )

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(
        run,
        "doc_id long, n_words long, base array<struct<start:long,label:string>>, "
        "found array<struct<start:long,label:string,share:double>>, score double",
    )
