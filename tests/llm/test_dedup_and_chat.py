"""Deduplication, chat formatting and the pipeline, against brute force."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from conftest import SF_CHECK, SF_SMALL
from mercato.llm import buckets, chat, decontam, minmax, near, paragraphs, qda
from mercato.llm import queries as Q
from oracle_check import compare, duck
from pyspark.sql import functions as F

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b]
        and 4 * min(len(sets[a]), len(sets[b])) >= 3 * max(len(sets[a]), len(sets[b]))
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in roots_of(ids, links).items()}


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 4000)}" for _ in range(n)]


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        text[rng.randrange(len(text))] = f"new{rng.randint(0, 10**9)}"
    return text


def near_rows():
    """Copies, a star (variants that link only to their original, whose id is
    not the smallest), chains, and pairs just around the limit."""
    rng = random.Random(11)
    rows = [(0, None), (1, ""), (2, "short text"), (3, "Short TEXT"), (4, "a b c d"), (5, " a  b c d\n")]
    star = words(rng, 200)
    rows += [(100 + i, " ".join(edited(rng, star, 6))) for i in range(60)] + [(500, " ".join(star))]
    link = words(rng, 150)
    for i in range(25):
        rows.append((600 + i, " ".join(link)))
        link = edited(rng, link, 3)
    for i in range(30):
        base = words(rng, 120)
        rows += [(700 + 2 * i, " ".join(base)), (701 + 2 * i, " ".join(edited(rng, base, rng.choice([2, 3, 4, 5]))))]
    copy = " ".join(words(rng, 60))
    return rows + [(1000 + i, copy) for i in range(40)]


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, 0, True) for r in rows], "doc_id long, text string, size int, kept boolean").repartition(4)
    got = minmax.near_duplicates(docs).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_near_duplicates_query(spark):
    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF_CHECK, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op8_minmax_near_duplicates(spark, SF_CHECK).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d e f"), (None, None), (7, "a b c d e f"), (7, "a b c d e f"), (8, "a b c d e f"), (9, None), (9, "x " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minmax.near_duplicates(docs).collect()), key=str)
    want = [(None, 2, None, True), (None, 0, None, True), (7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False), (9, 0, 9, True), (9, 1, 9, True)]
    assert got == sorted(want, key=str)
    assert minmax.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [tuple(sorted(rng.sample(range(100, 400), 2))) for _ in range(160)]
    got = {r.node: r.root for r in near.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots_of({x for e in links for x in e}, links)


def test_components_of_a_long_rising_chain_take_few_rounds(spark, monkeypatch):
    jobs = []
    kept = near.materialize
    monkeypatch.setattr(near, "materialize", lambda df: jobs.append(1) or kept(df))
    got = near.components(spark.range(10_000).selectExpr("id as a", "id + 1 as b"))
    assert got.count() == 10_001 and got.filter("root <> 0").count() == 0 and len(jobs) <= 20


def test_near_duplicates_leave_only_their_result(spark):
    import os

    from mercato.plans.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    docs = spark.createDataFrame(near_rows(), "doc_id long, text string")
    near_nodes = minmax.signatures(docs).filter("size > 0").select("node", "size", "keys").dropDuplicates(["node"])
    roots = near.near_components(near_nodes, lambda wanted: minmax.sets_of_documents(docs, docs.select("doc_id")).dropDuplicates(["node"]))
    assert roots.count() > 0 and len(set(os.listdir(folder)) - before) == 1


def test_a_bucket_of_far_variants_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng, seen, fresh = random.Random(5), [], iter(range(1000, 10**6))
    sets = []
    for _ in range(150):  # variants of one set, far from each other; some have near copies
        gone = set(rng.sample(range(60), 6))
        sets.append([k for k in range(60) if k not in gone] + [next(fresh) for _ in gone])
    sets += [[next(fresh), *x[1:]] for x in sets[:20]]
    pairs_before = near.similar_pairs
    monkeypatch.setattr(near, "similar_pairs", lambda pairs, *more: seen.append(pairs.count()) or pairs_before(pairs, *more))
    rows = spark.createDataFrame(list(enumerate(sets)), "node long, items array<long>")
    nodes = rows.select("node", F.size("items").alias("size"), F.array(F.lit(1).cast("long")).alias("keys"))
    got = {r.node: r.root for r in near.near_components(nodes, lambda wanted: rows).collect()}
    links = [(a, b) for a in range(170) for b in range(a) if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))]
    assert got == roots_of(range(170), links) and len(set(got.values())) > 50
    assert sum(seen) < 170 * 169 / 4


def test_a_member_of_many_buckets_differs_from_few_pivots(spark, monkeypatch):
    rng, met, fresh = random.Random(7), [], iter(range(1000, 10**6))
    sets, keys = [], []
    for k in range(120):  # variants of one set, far from each other, each in about half of 16 buckets
        gone = set(rng.sample(range(60), 6))
        sets.append([k for k in range(60) if k not in gone] + [next(fresh) for _ in gone])
        keys.append([b if rng.random() < 0.5 else 100 * k + b + 1000 for b in range(16)])
    sets += [[next(fresh), *x[1:]] for x in sets[:20]]
    keys += [list(range(16))] * 20
    pairs_before = near._differing_pairs
    monkeypatch.setattr(near, "_differing_pairs", lambda items, hubs: met.append(items.select("p", "node").distinct().count()) or pairs_before(items, hubs))
    rows = spark.createDataFrame(list(enumerate(sets)), "node long, items array<long>")
    nodes = spark.createDataFrame([(k, len(x), y) for k, (x, y) in enumerate(zip(sets, keys))], "node long, size int, keys array<long>")
    got = {r.node: r.root for r in near.near_components(nodes, lambda wanted: rows).collect()}
    near_pairs = [(a, b) for a in range(140) for b in range(a) if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))]
    assert got == roots_of(range(140), [(a, b) for a, b in near_pairs if set(keys[a]) & set(keys[b])]) and len(set(got.values())) > 50
    assert met and max(met) <= 2 * 140


def test_rounds_of_links_keep_plans_short(spark, monkeypatch):
    """The driver holds all stages of a plan, many of which would run at once."""
    rng, joins, fresh = random.Random(11), [], iter(range(1000, 10**6))
    sets = []
    for _ in range(60):  # variants of one set, far from each other: open after all rounds
        gone = set(rng.sample(range(60), 6))
        sets.append([k for k in range(60) if k not in gone] + [next(fresh) for _ in gone])
    sets += [[next(fresh), *x[1:]] for x in sets[:10]]
    rows = spark.createDataFrame(list(enumerate(sets)), "node long, items array<long>")
    nodes = rows.select("node", F.size("items").alias("size"), F.array(F.lit(1).cast("long")).alias("keys"))
    kept, differences, met = near.materialize, near._differences, []

    def counting(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return kept(df)

    monkeypatch.setattr(near, "materialize", counting)
    monkeypatch.setattr(near, "_differences", lambda *x: met.append(1) or differences(*x))
    got = {r.node: r.root for r in near.near_components(nodes, lambda wanted: rows).collect()}
    links = [(a, b) for a in range(70) for b in range(a) if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))]
    assert got == roots_of(range(70), links)
    assert met and max(joins) <= 4


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(1, 1 << 55, 4000, dtype=np.uint64)
    a, b = pool[:3500], pool[500:]
    factors, offsets = minmax.permutations(200)
    same = [f((a + o) * m) == f((b + o) * m) for m, o in zip(factors, offsets) for f in (np.min, np.max)]
    assert abs(np.mean(same) - 3000 / 4000) < 0.08


def test_key_filter_keeps_every_key(spark):
    import pyarrow as pa

    keys = [r * 7919 - 10**12 for r in range(3000)]
    known = near.KeyFilter(spark.createDataFrame([(k,) for k in keys] + [(None,)], "key long"))
    assert known.passes(pa.array(keys)).all()
    assert known.passes(pa.array([None, *range(10**15, 10**15 + 2000)], pa.int64())).sum() <= 2


# paragraphs

def grams(texts, n):
    out = collections.Counter()
    for t in texts:
        w = SPACED.findall((t or "").translate(LOWER))
        out.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    return out


def test_passages_over_fifty_words_stay_once(spark):
    rng = random.Random(8)
    passage, line = words(rng, 55), " ".join(words(rng, 40))
    rows = []
    for i in range(30):
        text = words(rng, 150)
        if i % 3 == 0:
            at = rng.randrange(150)
            text[at:at] = passage
        text = " ".join(text)
        if i % 4 == 0:
            own = line.split()
            own[rng.randrange(40)] = "edited"
            text = f"{text}\n{' '.join(own) if i else line}\nlast words {i}"
        rows.append((i, text, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(5)
    got = {r.doc_id: r for r in paragraphs.dedup_paragraphs(docs).collect()}
    after = grams([r.text for r in got.values()], 30)
    inner = [tuple(passage[k : k + 30]) for k in range(10, 16)]
    assert all(after[g] == 1 for g in inner)
    for i, text, _ in rows:
        if i % 3 and i % 4 or i == 0:
            assert got[i].text == text and got[i].n_removed == 0
    assert 0 in got[3].first_docs
    # near copies of the line (one word of forty edited: similarity 0.75 or more) go with their line break
    assert all(got[i].text.count("\n") == 1 for i in range(4, 30, 4) if 0 in got[i].first_docs and i % 3)


def test_passages_of_the_table(spark):
    docs = Q.table(spark, SF_CHECK, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in Q.op10_paragraph_minhash(spark, SF_CHECK).collect()}
    assert set(got) == set(text)
    before, after = grams(text.values(), 51), grams([r.text for r in got.values()], 51)
    assert max(after[g] for g, n in before.items() if n > 1) == 1
    at_20 = grams(text.values(), 20)
    for i, r in got.items():
        w = SPACED.findall(text[i].translate(LOWER))
        assert r.n_words == len(w) and r.n_removed == sum(s.end - s.start for s in r.removed)
        if not r.n_removed:
            assert r.text == text[i]
            continue
        left = [x for k, x in enumerate(w) if not any(s.start <= k < s.end for s in r.removed)]
        assert SPACED.findall(r.text.translate(LOWER)) == left
        for s in r.removed:  # only repeated text, or near copies of lines
            shared = sum(at_20[tuple(w[k : k + 20])] > 1 for k in range(s.start, s.end - 19))
            assert shared or "\n" in text[i]


def test_passages_of_removed_lines_stay_elsewhere(spark):
    rng = random.Random(21)
    line, passage = words(rng, 250), words(rng, 51)
    around = [" ".join(words(rng, 80)) for _ in range(4)]
    rows = [(1, " ".join(line)), (5, " ".join(line + passage)), (9, f"{around[0]} {' '.join(passage)} {around[1]}"), (12, f"{around[2]} {' '.join(passage)} {around[3]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in paragraphs.dedup_paragraphs(docs).collect()}
    assert got[5].text == "" and got[1].text == rows[0][1] and got[9].text == rows[2][1]
    assert got[12].n_removed and got[12].first_docs == [9]
    assert grams([r.text for r in got.values()], 51)[tuple(passage)] == 1


def test_passages_over_the_end_of_a_removed_line_stay(spark):
    rng = random.Random(5)
    line, passage = words(rng, 60), words(rng, 90)
    rows = [(20, " ".join(line)), (21, f"{' '.join(line)}\n{' '.join(passage)}"), (22, " ".join([*words(rng, 80), *line[-9:], *passage]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in paragraphs.dedup_paragraphs(docs).collect()}
    assert got[21].text == " ".join(passage) and got[22].n_removed > 0


def test_repeated_passages_of_the_table_stay(spark):
    docs = Q.table(spark, SF_CHECK, "documents")
    rows = paragraphs.with_key(docs, "doc_id", "text")
    parts = near.materialize(paragraphs.paragraphs_of(rows))
    gone = collections.defaultdict(set)
    for r in paragraphs.repeated_lines(parts, rows).collect():
        gone[r.doc_key].update(range(r.start, r.end))
    outside, total = collections.Counter(), collections.Counter()
    for r in rows.collect():
        w = SPACED.findall((r.text or "").translate(LOWER))
        for k in range(len(w) - 50):
            total[tuple(w[k : k + 51])] += 1
            outside[tuple(w[k : k + 51])] += gone[r.doc_key].isdisjoint(range(k, k + 51))
    texts = [r.text for r in Q.op10_paragraph_minhash(spark, SF_CHECK).collect()]
    after, at_20 = grams(texts, 51), grams(texts, 20)
    left = "\n".join(f" {' '.join(SPACED.findall((t or '').translate(LOWER)))} " for t in texts)
    repeated = [g for g, n in total.items() if n > 1 and outside[g]]
    assert repeated and max(after[g] for g in repeated) == 1 and sum(after[g] for g in repeated) >= 0.9 * len(repeated)
    for g in repeated:
        # one that spans two passages, whose first places differ, stays in parts; one that repeats itself, as its first period
        if not after[g] and not any(at_20[g[k : k + 20]] for k in range(32)):
            period = next(n for n in range(1, 52) if all(x == y for x, y in zip(g, g[n:])))
            assert period < 20 and any(f" {' '.join(g[k : k + period])} " in left for k in range(period)), g


def test_later_pieces_against_brute_force(spark, monkeypatch):
    """Pieces meet as blobs, in few rows, and the first place is the least free one."""
    monkeypatch.setattr(buckets, "WORK_BYTES", 1 << 10)
    rng = random.Random(14)
    common = [" ".join(words(rng, 60)) for _ in range(12)]
    rows = [(rng.choice([None, *range(-5, 60)]), "\n".join(f"{' '.join(words(rng, 3))} {t}" for t in rng.sample(common, 4))) for _ in range(120)]
    rows += [(None, f"{k} {alone}") for alone in [" ".join(words(rng, 60))] for k in ("one", "two")]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string").repartition(7)
    parts = near.materialize(paragraphs.paragraphs_of(paragraphs.with_key(docs, "doc_id", "text")))
    gone = {r.doc_key: [(5, 40), (64, 70)] for r in parts.collect() if r.doc_key % 3 == 0}
    places, n_pieces = collections.defaultdict(set), 0
    for batch in parts.toArrow().to_batches():
        hashes, row, start, n = paragraphs.pieces_of(batch)
        n_pieces += len(hashes)
        for h, r, s, k in zip(hashes.tolist(), row.tolist(), start.tolist(), n.tolist()):
            i, key = batch["doc_id"][r].as_py(), batch["doc_key"][r].as_py()
            free = all(not (a < s + k and s < b) for a, b in gone.get(key, []))
            places[h].add((i is None, i or 0, key, s, s + k, free))
    want = collections.Counter()
    for found in places.values():
        first = min((p for p in found if p[-1]), default=None)
        want.update((p[2], p[3], p[4], None if first[0] else first[1]) for p in found if first and p > first)
    lost = spark.createDataFrame([(k, *x) for k, spans in gone.items() for x in spans], "doc_key long, start long, end long")
    out = paragraphs.repeated_pieces(parts, lost, n_pieces).collect()
    got = collections.Counter()
    for r in out:
        columns = [np.frombuffer(bytes(r[c]), t).tolist() for c, t in (("doc_key", "<i8"), ("start", "<i4"), ("end", "<i4"), ("first_doc", "<i8"), ("flags", "u1"))]
        got.update((k, s, e, None if f & paragraphs.NO_FIRST else d) for k, s, e, d, f in zip(*columns))
    assert got == want and any(k[3] is None for k in want) and len(out) < sum(want.values()) / 2


def test_lines_are_confirmed_without_sketches(spark, monkeypatch):
    monkeypatch.setattr(near, "with_sketch", lambda sets: pytest.fail("sets of lines are hardly longer than a sketch"))
    rng = random.Random(15)
    line = words(rng, 60)
    rows = [(i, " ".join([*line[:i], "edited" if i else line[0], *line[i + 1 :]]) + f"\nown words {i}") for i in range(0, 60, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in paragraphs.dedup_paragraphs(docs).collect()}
    assert got[0] == 0 and all(got[i] >= 60 for i in got if i)


def test_lonely_items_against_a_count(spark):
    rng = random.Random(16)
    sets = {n: rng.sample(range(400), 30) for n in range(1, 41)}
    live = [n for n in sets if n % 4]
    rows = near.few(spark.createDataFrame(list(sets.items()), "node long, items array<long>"), 40)
    times = collections.Counter(x for n in live for x in sets[n])
    want = {n: k for n in live if (k := sum(times[x] == 1 for x in sets[n]))}
    got = near._lonely_items(spark.createDataFrame([(n,) for n in live * 2], "node long"), rows, 40).collect()
    assert {r.node: r.lonely for r in got} == want and len(got) == len(want)


def test_buckets_over_batches_stay_whole(monkeypatch):
    monkeypatch.setattr(buckets, "WORK_BYTES", 1)
    order = [5, 5, 5, 2, 2, 9, 1, 1, 1, 1, 7]  # partitions of one task, each in order
    batches = [pa.RecordBatch.from_arrays([pa.array(order[k : k + 2]), pa.array([str(i).encode() for i in range(k, min(k + 2, 11))])], names=["bucket", "x"]) for k in range(0, 11, 2)]
    tables = [t["bucket"].to_pylist() for t in buckets.whole_buckets(iter(batches))]
    assert sum(tables, []) == order and len(tables) > 2
    assert sum(len(set(t)) for t in tables) == len(set(order))


def test_paragraph_edges(spark):
    long_line = " ".join(f"k{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\n"), (4, long_line), (4, long_line), (5, long_line), (None, long_line), (6, "z " * 400), (7, "few words\nfew words")]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, removed string, n_words int")
    got = collections.defaultdict(set)
    for r in paragraphs.dedup_paragraphs(docs, keep=("doc_id", "removed")).collect():
        got[r.doc_id].add((r.text, r.n_removed, r.row.removed))
    assert got[1] == {(None, 0, "c")} and got[2] == {("", 0, "c")} and got[3] == {(" \n\n", 0, "c")}
    assert got[4] == {(long_line, 0, "c")} and got[5] == {("", 60, "c")} and got[None] == {("", 60, "c")}
    assert got[7] == {("few words\nfew words", 0, "c")}
    assert paragraphs.dedup_paragraphs(docs.limit(0)).count() == 0


# chat

def chat_turns():
    return [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "good"), (1, 3, "user", "bye"),
        (2, 0, "user", None), (2, 1, "assistant", "other"), (2, 1, "assistant", "other"), (2, 1, "user", "tie"),
        (3, 0, None, "no role"), (None, 0, "user", "lost"), (3, None, "user", "lost"), (3, 1, "user", ""),
        (4, 0, "assistant", None), (5, 0, "assistant", ""), (6, 2**40, "user", "x" * 100_000),
    ]


def test_preference_edges_against_the_oracle(spark, tmp_path):
    turns = spark.createDataFrame([(*r, True, 3) for r in chat_turns()], "conv_id long, turn long, role string, text string, trained boolean, place int")
    turns.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    r = compare(spark, con, "op9", Q.QUERIES["op9_preference_format"], Q.ORACLE["op9_preference_format"], str(tmp_path))
    assert r["ok"], r
    got = Q.QUERIES["op9_preference_format"](spark, str(tmp_path)).filter("pair_id = 1").orderBy("segment", "turn").collect()
    assert [(x.segment, x.turn, x.trained) for x in got] == [
        ("chosen", 2, True), ("chosen", 3, False), ("prompt", 0, False), ("prompt", 1, False), ("rejected", 2, True), ("rejected", 3, False),
    ]
    assert got[0].content == "<|assistant|>\ngood\n" and got[4].content == "<|assistant|>\nother\n"
    empty = chat.preference_turns(turns.limit(0).withColumn("c", F.lit(True)), F.col("conv_id"), F.col("c"))
    assert empty.count() == 0


def test_preference_query_against_the_oracle(spark):
    name = "op9_preference_format"
    r = compare(spark, duck(SF_CHECK), name, Q.QUERIES[name], Q.ORACLE[name], SF_CHECK)
    assert r["ok"], r


@pytest.mark.parametrize("name", ["op3_likelihood_ratio_rules", "op9_preference_format"])
def test_native_queries_run_no_python(spark, name):
    plan = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# pipeline

def test_near_dedup_stage_tells_rows_of_one_id_apart(spark):
    rng = random.Random(12)
    base, other = words(rng, 80), " ".join(words(rng, 50))
    near_base = " ".join(edited(rng, base, 1))
    rows = [
        (1, " ".join(base), "x", 5), (2, near_base, "x", 1), (2, other, "y", 7), (3, other, "y", 8), (4, None, "n", 0), (4, None, "n", 0),
        (5, "", "e", 2), (5, "", "e", 1), (None, other, "z", 1), (None, other, "z", 1), (6, "only one", "b", 9), (6, "only one", "a", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, text_hash int").repartition(4)
    got = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect()), key=str)
    want = [rows[0], rows[2], rows[4], rows[7], rows[8], rows[9], rows[11]]
    assert got == sorted(want, key=str)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_many_equal_rows_hold_their_spans_once(spark):
    rng = random.Random(3)
    line = " ".join(words(rng, 60))
    rows = [(1, f"{line}\nfirst {' '.join(words(rng, 30))}")] + [(None, f"{line}\nown text")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = paragraphs.dedup_paragraphs(docs).collect()
    assert len(got) == 3001 and {(r.text, len(r.removed)) for r in got if r.doc_id is None} == {("own text", 1)}


def test_pipeline_stage_by_stage(spark):
    docs = Q.table(spark, SF_CHECK, "documents")
    columns, before = docs.columns, docs.count()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "packing"]
    for name, stage in list(stages.items())[:-1]:
        out = near.materialize(stage(spark, docs, SF_CHECK))
        assert out.columns == columns
        rows = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r for r in out.collect()}
        if name == "quality classifier":
            model = Q.quality_model(docs, Q.table(spark, SF_CHECK, "labels"))
            scores = {r.doc_id: r.score for r in qda.score(qda.with_statistics(docs), model).collect()}
            assert set(kept) == {i for i in rows if scores[i] >= corpus_pipeline.LEAST_QUALITY} and set(kept) < set(rows)
        elif name == "MinHash near-dedup":
            want = brute_components([(i, r.text) for i, r in rows.items()])
            assert set(kept) == {c for _, c in want.values()} and all(kept[i] == rows[i] for i in kept)
        elif name == "substring dedup":
            all_51 = grams([r.text for r in kept.values()], 51)
            assert max(all_51.values()) == 1 and all(r.n_chars == len(r.text) for r in kept.values())
        else:
            bad = {r.doc_id for r in decontam.decontaminate(docs, Q.table(spark, SF_CHECK, "benchmark")).filter("contaminated").collect()}
            assert bad and set(kept) == set(rows) - bad
        docs = out
    pieces = stages["packing"](spark, docs, SF_CHECK).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()} and docs.count() < before
    whole = corpus_pipeline.run(spark, SF_CHECK)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(tuple(p[k] for k in key) for p in pieces) == sorted(tuple(r) for r in whole.select(*key).collect())
