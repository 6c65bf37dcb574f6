"""Reversible line dedup and fill-in-the-middle, against brute force and SQL."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from conftest import SF_CHECK
from mercato.llm import fim, linededup
from mercato.llm import queries as Q
from oracle_check import compare, duck

SPACE = " \t\n\v\f\r"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.mark.parametrize("name", ["op11_cuckoo_line_dedup", "op13_learned_rank_fim"])
def test_query_against_the_oracle(spark, name):
    r = compare(spark, duck(SF_CHECK), name, Q.QUERIES[name], Q.ORACLE[name], SF_CHECK)
    assert r["ok"] and r["rows"], r


# line dedup

def key(line):
    return line.strip(SPACE).translate(LOWER)


def brute_clean(texts, known, least):
    hot = {k for k, n in known.items() if n >= least and k}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in hot]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def brute_counts(texts):
    return collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})


def line_texts(seed, n):
    rng = random.Random(seed)
    common = [f"Common line {k}" for k in range(40)]
    texts = [None, "", "\n", " \n\t\n\x85\n", "É\né\nÉ ", "x" * 200_000 + "\ncommon LINE 1 "]
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"own {seed} {i} {rng.random()}" for _ in range(rng.randint(1, 8))]
        lines += ["  HOT line\t"] if rng.random() < 0.5 else []
        rng.shuffle(lines)
        texts.append("\n".join(x.upper() if rng.random() < 0.2 else f" {x}\r" for x in lines))
    return texts


def as_docs(spark, texts, first=0):
    rows = [(None if i % 17 == 3 else first + i // 2, t, i, "c") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_lines int, shard string").repartition(3)


def cleaned(index, docs):
    got = index.clean(docs, keep=("doc_id", "n_lines")).collect()
    assert all(r.doc_id == r.row.doc_id for r in got)
    return [(r.text, r["n_lines"], r.n_dropped) for r in sorted(got, key=lambda r: r.row.n_lines)]


def table_of(index):
    return sorted(map(tuple, index.removable().collect()))


def test_line_index_goes_up_and_down(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 8)
    monkeypatch.setattr(linededup, "HEAVY", 20)
    one, two = line_texts(1, 60), line_texts(2, 80)
    docs_one, docs_two = as_docs(spark, one), as_docs(spark, two, 1000)
    first = linededup.LineIndex(spark, 10).insert(docs_one)
    assert cleaned(first, docs_one) == brute_clean(one, brute_counts(one), 10)
    both = first.insert(docs_two)
    assert both.shards > 1 and len(both.heavy()[0]) <= 20
    total = brute_counts(one + two)
    assert len(table_of(both)) == sum(n >= 10 and k != "" for k, n in total.items())
    assert cleaned(both, docs_two) == brute_clean(two, total, 10)
    again = both.delete(docs_two)
    assert table_of(again) == table_of(first)
    assert cleaned(again, docs_one) == brute_clean(one, brute_counts(one), 10)
    none = again.delete(docs_one)
    assert none.removable().count() == 0 and none.places == 0
    with pytest.raises(ValueError):
        first.delete(docs_two)


def test_filters_hold_exactly_their_shards_keys(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 8)
    index = linededup.LineIndex(spark, 3).insert(as_docs(spark, line_texts(3, 50))).insert(as_docs(spark, line_texts(4, 50)))
    filters = {r.shard: linededup.CuckooFilter(0, r.table, r.stash) for r in index.filters.collect()}
    held = sum(int((f.table != 0).sum()) + len(f.stash) for f in filters.values())
    keys = index.removable().collect()
    assert held == len(keys)
    for r in keys:
        assert filters[r.k1 & (index.shards - 1)].contains(np.asarray([r.k1]), np.asarray([r.k2])).all()


def test_line_edges(spark):
    docs = spark.createDataFrame([(i, "same\n \nsame") for i in range(10)] + [(1, "same\n \nsame")], "doc_id long, text string")
    got = linededup.drop_common_lines(docs).collect()
    assert len(got) == 11 and {(r.text, r.n_lines, r.n_dropped) for r in got} == {(" ", 3, 2)}
    assert linededup.drop_common_lines(docs.limit(0)).count() == 0
    nine = linededup.drop_common_lines(docs.filter("doc_id < 9").dropDuplicates()).collect()
    assert {r.n_dropped for r in nine} == {0}


def test_cuckoo_filter_takes_more_than_it_was_made_for():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, (3000, 2))
    keys[:40, :] = keys[0]  # one fingerprint many times
    f = linededup.CuckooFilter(2000)
    f.insert(*keys.T)
    f = linededup.CuckooFilter(0, *f.to_bytes())
    assert f.stash and f.contains(*keys.T).all()
    f.delete(*keys[:1500].T)
    assert f.contains(*keys[1500:].T).all()
    f.delete(*keys[1500:].T)
    assert not f.table.any() and not f.stash
    with pytest.raises(KeyError):
        f.delete(*keys[:1].T)
    other = rng.integers(-(2**63), 2**63 - 1, (20000, 2))
    full = linededup.CuckooFilter(2000)
    full.insert(*keys[40:1800].T)
    assert full.contains(*other.T).mean() < 0.001


# fill in the middle

@pytest.mark.parametrize("error", [1, 2, 127, 1000])
def test_rank_index_is_exact_and_bounded(error):
    rng = np.random.default_rng(error)
    for steps in ([], [1], [1] * 500, rng.integers(1, 300, 2000), rng.pareto(0.6, 800).astype(np.int64) + 1, [10**9, 1, 1, 10**9]):
        offsets = np.concatenate([[0], np.cumsum(np.asarray(steps, np.int64))]).astype(np.int64)
        index = fim.RankIndex(offsets, error)
        assert [index.offset(r) for r in range(len(offsets))] == offsets.tolist()
        assert all(abs(index.predict(r) - o) <= error for r, o in enumerate(offsets.tolist()))
    assert len(fim.RankIndex(np.arange(0, 50_000, 50), 127).first) == 1


def test_every_cut_of_a_text_comes_back(spark):
    rng = random.Random(6)
    texts = ["é" * rng.randint(0, 3) + "\n" * rng.randint(0, 3) + "".join(rng.choice(["a\n", "ü", "\r\n", "longer line \n", "<", "P>"]) for _ in range(60)) for _ in range(300)]
    texts += [None, "", "\n", "no break", "x\n" * 50_000, "has <S> in it\nand more", "<P>"]
    rows = [(None if i == 5 else i, t, "c", 1) for i, t in enumerate(texts)] + [(7, texts[7], "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3)
    got = fim.fill_in_middle(docs).collect()
    assert len(got) == len(rows)
    forms = collections.Counter()
    for r in got:
        t = texts[5] if r.doc_id is None else texts[r.doc_id] or ""
        units = t.splitlines(keepends=True) if "\r" not in t else [u + "\n" for u in t.split("\n")[:-1]] + ([t.split("\n")[-1]] if t.split("\n")[-1] else [])
        h = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, _, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        n = len(units)
        lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix, middle, suffix = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")):
            want = ("plain", None, None, t)
        elif h4 % 100 < 50:
            want = ("spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
        else:
            want = ("psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) == (n, *want, t)
        assert r.largest_residual <= fim.ERROR
        forms[r.form] += 1
    assert min(forms.values()) >= 4 and set(forms) == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
