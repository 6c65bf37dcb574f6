"""Conversation repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_CHECK
from mercato.llm import queries as Q
from mercato.llm import repair

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
SOUND = re.compile(r"(s?(ua)+)?\Z")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if case == 3 else 1)
    return out


def order(row):
    return row[1] is not None, row[1] or 0, row[2].encode(), row[3].encode()


def faults_of(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        inked = text.rstrip(" \t\n\v\f\r")
        if BLANK.match(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("sound" if inked[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """(cost, least audit) from the back over all prefixes of sound strings."""
    def after(state, x):
        nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        return nxt.get((state, x))

    far = (1 << 60, "")
    best = {"": (0, ""), "s": far, "u": far, "a": (0, "")}

    def with_inserts(best):
        for _ in range(3):
            for state in best:
                for x in "ua":
                    to = after(state, x)
                    if to:
                        best[state] = min(best[state], (best[to][0] + 3, "I" + best[to][1]))
        return best

    best = with_inserts(best)
    for x, fault in zip(reversed(initials), reversed(faults)):
        new = {}
        for state in best:
            options = [(best[state][0] + 4, "D" + best[state][1])]
            if fault in ("sound", "truncated"):
                extra = 3 if fault == "truncated" else 0
                if after(state, x):
                    to = best[after(state, x)]
                    options.append((to[0] + extra, "K" + to[1]))
                for y in "ua":
                    if after(state, y):
                        to = best[after(state, y)]
                        options.append((to[0] + 3 + extra, "R" + to[1]))
            new[state] = min(options)
        best = with_inserts(new)
    return best[""]


def applied(rows, audit):
    out, rows, last = [], iter(rows), ""
    for x in audit:
        due = "assistant" if last == "u" else "user"
        if x == "I":
            out.append((due, ""))
        else:
            _, _, role, text = next(rows)
            if x == "D":
                continue
            out.append((role if x == "K" else due, text))
        last = out[-1][0][:1]
    assert next(rows, None) is None
    return out


def brute(rows):
    convs = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, these in convs.items():
        these.sort(key=order)
        initials, faults = [r[2][:1] for r in these], faults_of(these)
        turns = [r[1] for r in these if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = cheapest(initials, faults)
        done = applied(these, audit)
        assert SOUND.match("".join(r[:1] for r, _ in done))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def of_query(spark, folder):
    rows = Q.QUERIES["op12_checkpointed_repair"](spark, str(folder)).collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def random_turns(seed, convs):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, 25)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "unknown", "", None, "Tool", "admin"])
            text = rng.choice(["Well.", "No end", "same!", " \t", "", None, "a?\n", "b. ", "\x85", f"own {rng.random()}."])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None, 2 * turn]), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def written(spark, rows, folder, parts=3):
    schema = "conv_id long, turn long, role string, text string, copies long, part string"
    spark.createDataFrame([(*r, 9, "p") for r in rows], schema).repartition(parts).write.parquet(str(folder / "conversations.parquet"))
    return folder


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in Q.table(spark, SF_CHECK, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert of_query(spark, SF_CHECK) == brute(rows)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_random_conversations_against_brute_force(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_turns(block, 300)
    rows += [(None, t, r, x) for t, r, x in [(None, "user", "A."), (1, "assistant", "B."), (1, "assistant", "B."), (3, "user", "c")]]
    # a conversation of which little is left, a long one, one that repeats itself
    rows += [(9000 + i, i, None, None) for i in range(40)]
    rows += [(5, 1000 + i, random.Random(i).choice(["user", "assistant"]), f"{i}." if i % 7 else "again.") for i in range(900)]
    rows += [(6, 50, "user", "the same.")] * 300
    assert of_query(spark, written(spark, rows, tmp_path)) == brute(rows)


def test_copies_are_cut_into_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_COPIES", 7)
    rows = [(1, 1, "user", "u.")] * 40 + [(1, 2, "assistant", "a")] * 15 + [(1, 3, "user", "")] * 20
    assert of_query(spark, written(spark, rows, tmp_path)) == brute(rows)


def test_dropped_conversations_and_no_rows(spark, tmp_path):
    rows = [(i, 0, "user", "x.") for i in range(60)]
    want = brute(rows)
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want.values()
    assert of_query(spark, written(spark, rows, tmp_path)) == want
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    done = repair.repair(empty)
    assert done.edits.count() == 0 and done.conversations.count() == 0


def test_block_matrix_is_the_product_of_its_rows():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64):
        codes = rng.integers(0, 9, n).astype(np.uint8)
        copies = np.where(codes == 0, rng.integers(1, 5, n), 1)
        after = [0, 6, 3, 0]
        for code, k in zip(codes[::-1], copies[::-1]):
            after = [c + (4 * (k - 1) if code == 0 else 0) for c in repair.costs_before(repair.STEPS[code], after)]
        assert repair.costs_before(repair.block_matrix(codes, copies), repair.FINAL) == after


def test_long_conversation_is_spread_over_blocks_of_root_length(spark):
    rows = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat(id, '.') as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be one task
    try:
        blocks = repair._blocks(repair._ordered_rows(rows, "conv_id", "turn", "role", "text")).select("part", "codes").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({b.part for b in blocks}) > 1  # by ranges of turns
    assert len(blocks) <= 4 * 26 and max(len(b.codes) for b in blocks) <= 26 * 64
    done = repair.repair(rows)
    assert done.conversations.first().cost == 0 and done.edits.filter("edit <> 'K'").count() == 0
