"""Operators on single documents, against brute force and on edge rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_CHECK
from mercato.llm import decontam, html, langid, licenses, packing, qda, quality_rules
from mercato.llm import queries as Q

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

TEXTS = [
    None, "", "   \n\t ", "word", "A bé Σασ it's 12ab34 <|endoftext|> x", "123 456 !!! $$$", "é 日本語 \U0001f600 ½",
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen",
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen",
    "a b c d e f\nA b c d e f\n\n a b c d e f \nlast line", "z " * 60, "no-space-" * 3000,
    "Licensed under CC BY 4.0. All Rights Reserved. GNU General Public License general public license",
    " ".join(f"w{i % 977}x{i % 31}" for i in range(20000)),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, repeated and very long rows, and columns that clash with
    results."""
    rows = [(i, t, ("en", "fr", None)[i % 3], "s", 1.0, True, 7, 8) for i, t in enumerate(TEXTS)]
    rows += [(None, "a row without id", "en", None, None, None, None, None), (3, "word", "en", "s", 0.0, False, 1, 1)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score double, kept boolean, n_words int, size long"
    ).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return Q.table(spark, SF_CHECK, "documents")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.tokenizer_path())


# packing

def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    lengths = [rng.choice([0, 1, rng.randint(1, 64), rng.randint(1, 200)]) for _ in range(400)]
    got = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    rest = []
    want = []
    for i, n in enumerate(lengths):
        for k in range(n // 64):
            want.append((i, k * 64, 64))
            room.append(0)
        if n % 64:
            rest.append((n % 64, i, n - n % 64))
    fits = {}
    for n, i, start in sorted(rest, key=lambda r: (-r[0], r[1])):
        able = [r for r in room if r >= n]
        best = min(able, default=64)
        if able:
            room.remove(best)
        room.append(best - n)
        fits[i] = 64 - best
        want.append((i, start, n))
    assert sorted(p[:3] for p in got) == sorted(want)
    assert {p[0]: p[4] for p in got if p[2] < 64 and p[1] == lengths[p[0]] // 64 * 64} == fits
    assert len({p[3] for p in got}) == len(room)


def test_packing_round_trip(spark, edge):
    t = tokenizer()
    got = packing.pack(edge, Q.tokenizer_path(), block_tokens=3000).collect()
    want = collections.Counter()
    for r in edge.collect():
        want[(r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids) + (2,))] += 1
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for r in got:
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(ids) == r.length
        by_doc[(r.doc_id, r.doc_tokens)].append((r.start, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    total = sum(len(k[1]) * n for k, n in want.items())
    assert sum(r.length for r in got) == total
    for (doc_id, ids), n in want.items():
        pieces = sorted(by_doc[(doc_id, len(ids))])
        at = 0
        for start, part in pieces[:: n]:
            assert start == at and part == ids[start : start + len(part)]
            at += len(part)
        assert at == len(ids)
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_packed_digest_and_empty_table(spark, edge):
    rows = Q.packed(edge.filter("doc_id = 4")).collect()
    ids = tokenizer().encode(TEXTS[4], add_special_tokens=False).ids + [2]
    assert [(r.start, r.length, r.ids_crc32) for r in rows] == [(0, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))]
    assert Q.packed(edge.limit(0)).count() == 0


# HTML

def test_minimum_cut_is_least():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def cost(kept):
            return sum(max(o, 0) if not k else max(-o, 0) for o, k in zip(odds, kept)) + sum(w for i, j, w in edges if kept[i] != kept[j])

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert math.isclose(cost(html.minimum_cut(odds, edges)), best, abs_tol=1e-6)


def test_main_text_of_a_full_page():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header>
    <div id="cookie-notice">We use cookies</div><nav><a href=x>Home</a></nav><article><h1>The   title</h1>
    <p>First &lt;b&gt; paragraph, 3 < 4, with <b>some</b> words &amp; more.<p>Second one goes on for a while
    and ends here.<script>var t="</p>";</script><div class="ad">Buy now</div><ul><li>item one<li>item two</ul>
    <form><label>Name</label><input></form><section class="comments"><p>I like this article very much, thanks a lot.</p></section>
    </article><aside>Related things to read next.</aside><footer>(c)</footer></body>"""
    assert html.main_text(page)[0] == (
        "The title\nFirst <b> paragraph, 3 < 4, with some words & more.\nSecond one goes on for a while and ends here.\nitem one\nitem two"
    )


PARAGRAPHS = ["The first paragraph of this page has some words.", "Another one follows it here, with a few more of them."]


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single sidebar">{}', '<html id="page" class="widget"><body class="header-fixed">{}', '<div class="comments-open">{}</div>',
        '<div id="page-with-sidebar"><article>{}</article></div>', '<div class="has-sidebar"><div class="sidebar">{}</div></div>',
        '<div class="widget"><main>{}</main></div>', '<div class="header"><article>{}</article></div><div class="comments">x</div>',
    ],
)
def test_names_of_wrappers_spare_the_text(page):
    text = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    assert html.main_text(page.format(text) + '<div class="sidebar"><p>Some other things to read.</p></div>')[0].split("\n") == PARAGRAPHS


@pytest.mark.parametrize(
    "name", ["comments", "comment-list", "site-nav", "sidebarLeft", "widget--wide", "post author-bio", "cookie_notice", "related-posts"]
)
def test_bad_names_take_their_text(name):
    text = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    long = "This one has a long tail of words that nobody wrote for the article. " * 4
    for other in (f'<div class="{name}"><p>{long}</p></div>', f'<aside>x</aside><div id="{name.split()[-1]}"><article class="comment"><p>{long}</p></article></div>'):
        for page in (f"<article>{text}</article>{other}", f"<main>{text}{other}</main>"):
            assert html.main_text(page)[0].split("\n") == PARAGRAPHS


@pytest.mark.parametrize(
    "silent, text",
    [
        ('<svg class="i"/>', "one two"), ("<math/>", "one two"), ("<video-player src=x></video-player>", "one two"),
        ("<select-box>own</select-box>", "one own two"), ("<object data=x>", "one two"), ("<video src=x><p>mid</p><video src=y>no</video>", "one mid two"),
        ("<svg><svg>no</svg><title/>no</svg>", "one two"), ("<object><object>no</object>no</object >", "one two"), ('<svg aria-label="a > b"/>', "one two"),
        ("<script>no</script x>", "one two"), ("<SCRIPT>no", "one"), ("<textarea>no", "one"), ("<template><svg>no</template>", "one two"),
        ("<!-- <svg> -->", "one two"), ("<svg a='1' " + 'b="2" ' * 60, "one"),
    ],
)
def test_silent_elements_end_where_they_end(silent, text):
    page = f"<article><p>one</p>{silent}<p>two</p></article>" if not silent.endswith(" ") else f"<article><p>one</p>{silent}"
    assert " ".join(b.text for b in html.blocks_of(page)) == text


def test_pages_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>cut <b>off <a hre"), (3, "u", "<p>cut <b>off <a hre"), (None, "u", "<nav>x</nav>"), (5, "u", "<div>" * 500 + "plain words stand here. " * 900)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_kept int")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[1] == got[2] == got[None] == "" and got[3] == "cut off"
    assert got[5] == ("plain words stand here. " * 900).strip()
    assert html.extract(pages.limit(0)).count() == 0


# quality rules

def base_of(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_rules_against_brute_force(spark, edge):
    labels = spark.createDataFrame([(7, 1), (7, 1), (9, 1), (10, 0), (4, None), (None, 1)], "doc_id long, quality int")
    ratios = quality_rules.log_ratios(quality_rules.bucket_counts(edge, labels, buckets=64), 64)
    got = quality_rules.score(edge, ratios).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    words = sorted({w for _, t in rows for w in SPACED.findall(t or "")})
    hashes = dict(spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) h").collect())
    pairs = sorted({(hashes[a], hashes[b]) for _, t in rows for a, b in itertools.pairwise(SPACED.findall(t or ""))})
    paired = {(r.a, r.b): r.h for r in spark.createDataFrame(pairs, "a long, b long").selectExpr("a", "b", "xxhash64(a, b) h").collect()}

    def grams(text):
        h = [hashes[w] for w in SPACED.findall(text or "")]
        return [x % 64 for x in h] + [paired[p] % 64 for p in itertools.pairwise(h)]

    raw = collections.Counter(g for _, t in rows for g in grams(t))
    target = collections.Counter(g for i, t in rows if i in (7, 9) for g in grams(t))
    ratio = [math.log((target[g] + 1) / (target.total() + 64)) - math.log((raw[g] + 1) / (raw.total() + 64)) if raw[g] else 0 for g in range(64)]
    want = collections.defaultdict(list)
    for i, t in rows:
        g = grams(t)
        want[(i, *base_of(t))].append(sum(ratio[x] for x in g) / len(g) if g else 0.0)
    for r in got:
        scores = want[tuple(r)[:7]]
        assert any(math.isclose(r.score, s, abs_tol=1e-5) for s in scores), r
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)
    assert len(got) == len(rows)


def test_rules_separate_labelled_documents(spark, docs):
    labels = Q.table(spark, SF_CHECK, "labels")
    rows = Q.op3_likelihood_ratio_rules(spark, SF_CHECK).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_rules_without_labels_or_rows(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int")
    ratios = quality_rules.log_ratios(quality_rules.bucket_counts(edge, none))
    assert set(ratios) == {0.0}
    assert quality_rules.score(edge.limit(0), ratios).count() == 0


# decontamination

def contaminated_of(text, items, window=13):
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.update([] if item is None else [str(item)])
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


def test_decontamination_against_brute_force(spark, edge):
    items = [(1, "Seven, EIGHT nine"), (2, " ".join(TEXTS[7].split()[1:])), (2, "word"), (10, None), (11, "!!"), (None, "one two"), (None, "a row without"), (30, "b c d e f a b c"), (31, "bé")]
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, n_words int")
    want = sorted(((r.doc_id, *contaminated_of(r.text, items)) for r in edge.collect()), key=str)
    for block_bytes in (1 << 20, 20):
        got = decontam.decontaminate(edge, bench, block_bytes=block_bytes, keep=("doc_id", "score"))
        rows = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()), key=str)
        assert rows == want
    none = decontam.decontaminate(edge, bench.limit(0))
    assert none.filter("contaminated or n_hit > 0").count() == 0 and none.count() == edge.count()


def test_decontamination_query(spark, docs):
    items = [(r.item_id, r.text) for r in Q.table(spark, SF_CHECK, "benchmark").collect()]
    got = {r.doc_id: r for r in Q.op4_suffix_decontamination(spark, SF_CHECK).collect()}
    hit = 0
    for r in docs.orderBy("doc_id").limit(250).collect():
        n, n_hit, found, bad = contaminated_of(r.text, items)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, n_hit, len(found), bad)
        assert g.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        hit += bad
    assert hit


def test_longest_match_and_place(spark):
    text = "x y " + " ".join(f"q{i}" for i in range(40)) + " z"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "p " + " ".join(f"q{i}" for i in range(3, 25)) + " r")], "item_id long, text string")
    assert [tuple(m) for m in decontam.decontaminate(docs, bench).first().matches] == [("5", 1, 5, 22)]


# language

def test_language_held_out(spark, docs):
    rows = Q.op5_language_family(spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_edges(spark, edge):
    model = langid.fit(edge)
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(edge, model).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (5, "und")} <= got
    assert {lang for _, lang in got} <= {"und", "en", "fr"}
    nothing = langid.fit(edge.limit(0))
    assert {r.lang_pred for r in langid.predict(edge, nothing).collect()} == {"und"}
    single = langid.fit(edge.filter("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in langid.predict(edge.filter("doc_id = 7"), single).collect()} == {("en", 1.0)}


def test_every_letter_gets_a_language(spark, docs):
    model = langid.fit(docs)
    texts = ["A.", "a", "a b", "é", " x", "ß\n", "日", "1", ".", "", None, "ª", "--a--", "ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in langid.predict(rows, model).collect()}
    for i, text in enumerate(texts):
        assert (got[i].lang_pred == "und") == (not any(map(str.isalpha, text or ""))), text
        assert (got[i].score == 0) == (got[i].lang_pred == "und")


# quality classifier

def test_quality_held_out(spark, docs):
    labels = Q.table(spark, SF_CHECK, "labels")
    rows = Q.op6_quadratic_quality(spark, SF_CHECK).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_gaussian_matches_the_formula():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(5, 5))
    cov, mean, x = a @ a.T + np.eye(5), rng.normal(size=5), rng.normal(size=(7, 5))
    g = qda.Gaussian.of(mean, cov)
    d = x - mean
    want = -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])
    assert np.allclose(g.log_density(x), want)


def test_quality_model_takes_one_worker_a_task(spark, docs):
    """The statistics and the moments are two stages, however few the labels."""
    seen, fit = [], qda.fit
    labels = spark.createDataFrame([(r.doc_id, r.doc_id % 2) for r in docs.select("doc_id").limit(40).collect()], "doc_id long, quality int")
    try:
        qda.fit = lambda rows: seen.append(rows.mapInArrow(lambda batches: batches, "x array<double>, label int")) or fit(rows)
        model = Q.quality_model(docs, labels)
    finally:
        qda.fit = fit
    assert model.low is not None
    rows = seen[0]
    rows.count()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    above, below = plan.index("MapInArrow"), plan.rindex("MapInArrow")
    assert above < below and "Broadcast" not in plan and "Exchange hashpartitioning(doc_id" in plan[above:below]


def test_quality_edges(spark, edge):
    stats = qda.with_statistics(edge)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    model = qda.fit(qda.labelled(stats, labels))
    assert model.low is None and {r.score for r in qda.score(stats, model).collect()} == {0.0}
    assert qda.fit(qda.labelled(stats, labels.limit(0))).prior == 0.5
    assert qda.score(qda.with_statistics(edge.limit(0)), model).count() == 0
    assert all(np.isfinite(r.x).all() for r in stats.collect())
    assert qda.keep_good(edge, qda.Model(1.0), 0.5).columns == edge.columns


# licences

def test_licence_base_and_labels(spark, edge):
    weights = licenses.word_weights(edge)
    got = licenses.scan(edge, weights)
    rows = {(r.doc_id, r.text) for r in edge.collect()}
    by_text = {r.doc_id: r for r in got.collect() if r.doc_id != 3}
    for doc_id, text in rows:
        if doc_id == 3:
            continue
        words = ALNUM.findall((text or "").translate(LOWER))
        places = sorted(
            (i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
        )
        r = by_text[doc_id]
        assert r.n_words == len(words) and [tuple(b) for b in r.base] == places
    assert [f.label for f in by_text[12].found] == ["cc-by"]
    assert by_text[0].score == 0 and licenses.scan(edge.limit(0), {}).count() == 0


def test_every_template_is_found(spark):
    rows = [(i, f"some words before, {text.upper()}. And some after.") for i, (_, text, _) in enumerate(licenses.TEMPLATES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.word_weights(docs)).collect()}
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert (3, label) in {(f.start, f.label) for f in got[i].found} and math.isclose(got[i].score, 1.0)
