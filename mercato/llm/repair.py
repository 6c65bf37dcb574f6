"""Repair of conversation structure by a square-root checkpointed program.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Rows
may be kept, given another role, deleted, and rows may be inserted; the cheapest
edits are wanted, and among those the ASCII-least string of their initials. The
program has four states (nothing yet, after ``s``, after ``u``, after ``a``) and
one cost vector per row, the cheapest way to the end from each state.

Vectors are not kept for every row. A conversation's rows, in order, are cut into
blocks that grow by BLOCK rows each, so n rows make about sqrt(2n / BLOCK) blocks,
none longer than about sqrt(2n * BLOCK) rows:

1. each block is reduced to the (min, +) matrix of its rows, and to its codes (a
   byte a row);
2. per conversation the matrices are applied from the last block to the first:
   the cost vector after every block, a checkpoint. This one table of a
   conversation's blocks is all that ever meets in one place;
3. each block makes its own vectors again from its checkpoint and walks forward
   from each of the four states, taking the ASCII-least edit that stays cheapest.
   Which of the four walks is the conversation's follows from the walks' last
   states, block after block;
4. the chosen walks meet the blocks' rows and give the edits.

So a conversation of any length is spread over many tasks; rows are put in order
by ranges, equal rows are counted into one before they move, and the first place
of a text is found by a partial minimum. Only ``digests`` reads a conversation
in one task, as one hash over all of it must: row by row, keeping its letters.

Defined cases: null roles and texts are one space, null turns come first; rows of
one turn are ordered by role, then text, and equal rows are next to each other; a
null conversation id is a conversation; an unknown role can be kept only if its
initial fits; a blank row is no duplicate, a duplicate not truncated; columns
other than the four named ones are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.plans.joins import join_on_keys
from mercato.plans.session import materialize

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

#: Rows of a conversation's first block, and by how many each next one is longer.
BLOCK = 64
#: A block also ends at this many bytes of text or copies of rows.
BLOCK_BYTES, BLOCK_COPIES = 1 << 20, 1 << 16

# States: what the repaired rows end with so far. START and ENDS_A may be the end.
START, ENDS_S, ENDS_U, ENDS_A = range(4)
FAR = 1 << 50
#: State after a row of the role that is due in a state, and that role.
DUE = {START: (ENDS_U, "user"), ENDS_S: (ENDS_U, "user"), ENDS_U: (ENDS_A, "assistant"), ENDS_A: (ENDS_U, "user")}
#: Cheapest way to a sound end without further rows.
FINAL = [0, 2 * INSERT_COST, INSERT_COST, 0]

# Codes of rows: FORCED must be deleted, the others tell initial and truncation.
FORCED = 0
INITIALS = "sua"


def code_of(role: str, truncated: bool) -> int:
    place = INITIALS.find(role[:1]) if role else -1
    return 1 + 2 * (place if place >= 0 else len(INITIALS)) + truncated


def keep_state(code: int, state: int) -> int | None:
    """State after keeping a row of this code, None where that is unsound."""
    initial = (code - 1) // 2
    if initial == 0:
        return ENDS_S if state == START else None
    if initial == 1:
        return ENDS_U if state != ENDS_U else None
    return ENDS_A if initial == 2 and state == ENDS_U else None


def _step(code: int) -> np.ndarray:
    """(min, +) matrix of insertions before a row and the row's own edit."""
    insert = np.full((4, 4), FAR, np.int64)
    for state in range(4):
        at, cost = state, 0
        for _ in range(3):
            insert[state, at] = min(insert[state, at], cost)
            at, cost = DUE[at][0], cost + INSERT_COST
    row = np.full((4, 4), FAR, np.int64)
    for state in range(4):
        row[state, state] = DELETE_COST
        if code != FORCED:
            extra = TRUNCATED_COST * ((code - 1) % 2)
            row[state, DUE[state][0]] = min(row[state, DUE[state][0]], REROLE_COST + extra)
            kept = keep_state(code, state)
            if kept is not None:
                row[state, kept] = min(row[state, kept], extra)
    return _times(insert[None], row[None])[0]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of stacks of 4 x 4 matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), FAR)


STEPS = np.stack([_step(code) for code in range(1 + 2 * (len(INITIALS) + 1))])


def block_matrix(codes: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """(min, +) product of a block's rows, by halving."""
    stack = STEPS[codes]
    forced = codes == FORCED
    if forced.any():
        stack = stack.copy()
        # copies that must go change nothing but the cost
        stack[forced] += ((copies[forced] - 1) * DELETE_COST)[:, None, None]
    while len(stack) > 1:
        odd = stack[-1:] if len(stack) % 2 else stack[:0]
        even = len(stack) // 2 * 2
        stack = np.concatenate([_times(stack[0:even:2], stack[1:even:2]), odd])
    return np.minimum(stack[0], FAR)


def costs_before(matrix, after: list[int]) -> list[int]:
    return [min(m + v for m, v in zip(row, after)) for row in matrix]


def walk(codes: list[int], copies: list[int], after: list[int], last: bool) -> tuple[list[int], list[str]]:
    """For each state at the block's start: the state at its end and the least
    string of cheapest edits. ``after`` holds the costs behind the block."""
    steps = STEPS.tolist()
    costs = [after]
    for code, n in zip(reversed(codes), reversed(copies)):
        before = costs_before(steps[code], costs[-1])
        costs.append([c + (n - 1) * DELETE_COST for c in before] if code == FORCED else before)
    costs.reverse()
    ends, audits = [], []
    for state in range(4):
        out = []
        for i, code in enumerate(codes):
            if code == FORCED:
                out.append(DELETE * copies[i])
                continue
            extra = TRUNCATED_COST * ((code - 1) % 2)
            here, then = costs[i], costs[i + 1]
            while True:  # edits in ASCII order; an insertion stays before the row
                due = DUE[state][0]
                if here[state] == DELETE_COST + then[state]:
                    out.append(DELETE)
                    break
                if here[state] == INSERT_COST + here[due]:
                    out.append(INSERT)
                    state = due
                    continue
                kept = keep_state(code, state)
                if kept is not None and here[state] == extra + then[kept]:
                    out.append(KEEP)
                    state = kept
                else:
                    out.append(REROLE)
                    state = due
                break
        while last and state not in (START, ENDS_A):
            out.append(INSERT)
            state = DUE[state][0]
        ends.append(state)
        audits.append("".join(out))
    return ends, audits


# ------------------------------------------------------------------ rows


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with faults, by a hash of conversation and turn in 20 cases:
    rows dropped, emptied, without their full stops, repeated, said by the user."""
    conv_id, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    case = F.crc32(key) % 20
    role, text = _filled(role_col), _filled(text_col)
    rows = turns.select(
        conv_id.alias("conv_id"),
        turn.alias("turn"),
        F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        case.alias("case"),
    )
    copies = F.when(F.col("case") == 3, 2).otherwise(1)
    return rows.filter("case <> 0").select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def _filled(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _ordered_rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct rows with their copies and whether the text was said before, in
    order of conversation and turn over all partitions."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        _filled(role_col).alias("role"), _filled(text_col).alias("text"),
    )
    distinct = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")))
    said = F.xxhash64("role", "text").alias("said")
    # turns are distinct here, so a text said once has one row; null turns are least
    first = distinct.groupBy("conv_id", said).agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first")).filter("n > 1")
    marked = join_on_keys(distinct.withColumn("said", said), first.drop("n"), ["conv_id", "said"])
    earlier = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    marked = marked.select("conv_id", "turn", "role", "text", "copies", earlier.alias("earlier"), F.substring("text", 1, 64).alias("head"))
    ranged = marked.repartitionByRange("conv_id", "turn", "role", "head").drop("head")
    return ranged.sortWithinPartitions("conv_id", "turn", "role", "text")


BLOCKS = (
    "conv_id long, part int, block long, codes binary, copies array<int>, matrix array<long>, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "turns long, least long, greatest long, rows array<struct<turn:long,role:string,text:string>>"
)
SPACE = " \t\n\v\f\r"


class Block:
    """Successive rows of one conversation."""

    def __init__(self, conv_id: int | None, most: int) -> None:
        self.conv_id, self.most = conv_id, most
        self.codes, self.copies, self.rows = bytearray(), [], []
        self.bytes = self.all_copies = self.n_distinct = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.greatest = None

    def full(self) -> bool:
        return self.n_distinct >= self.most or self.bytes >= BLOCK_BYTES or self.all_copies >= BLOCK_COPIES

    def add(self, turn, role: str, text: str, copies: int, fault: str) -> None:
        """``copies`` equal rows of one fault; more than one only if they must go."""
        initial = role[:1]
        pair = (self.last or "") + initial if self.rows else "su"
        same = 0 if initial + initial in ("su", "ua", "au") else copies - 1
        self.illegal += same + (pair not in ("su", "ua", "au"))
        if not self.rows:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += turn != self.greatest
            self.least = turn if self.least is None else self.least
            self.greatest = turn
        if fault == "blank":
            self.blank += copies
        elif fault == "duplicate":
            self.duplicate += copies
        else:
            self.truncated += fault == "truncated"
        self.codes.append(FORCED if fault in ("blank", "duplicate") else code_of(role, fault == "truncated"))
        self.copies.append(copies)
        self.rows.append({"turn": turn, "role": role, "text": text})
        self.bytes += len(text) + len(role)
        self.all_copies += copies
        self.n_distinct += 1

    def as_row(self, part: int, number: int) -> dict:
        matrix = block_matrix(np.frombuffer(bytes(self.codes), np.uint8), np.asarray(self.copies, np.int64))
        counted = ("blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "least", "greatest", "rows", "copies", "conv_id")
        return {k: getattr(self, k) for k in counted} | {
            "part": part, "block": number, "codes": bytes(self.codes), "matrix": matrix.ravel().tolist(),
        }


BLOCK_ROWS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()),
    ("copies", pa.list_(pa.int32())), ("matrix", pa.list_(pa.int64())),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("turns", pa.int64()), ("least", pa.int64()), ("greatest", pa.int64()),
    ("rows", pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))),
])


def _fault(role: str, text: str, earlier: bool) -> str:
    inked = text.rstrip(SPACE)
    if not inked:
        return "blank"
    return "duplicate" if earlier else "sound" if inked[-1] in ".!?" else "truncated"


def _pieces(row: dict) -> Iterator[tuple[int, str]]:
    """(copies, fault) of the equal rows that ``row`` stands for."""
    fault, n = _fault(row["role"], row["text"], row["earlier"]), row["copies"]
    if fault in ("sound", "truncated"):
        yield 1, fault
        fault, n = "duplicate", n - 1
    while n > 0:
        yield min(n, BLOCK_COPIES), fault
        n -= BLOCK_COPIES


def _blocks(ordered: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, block, ready, held = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for row in batch.slice(lo, 256).to_pylist():
                    for copies, fault in _pieces(row):
                        new = block is None or block.conv_id != row["conv_id"]
                        if new or block.full():
                            if block is not None:
                                ready.append(block.as_row(part, number))
                                number, held = number + 1, held + block.bytes + block.n_distinct
                            block = Block(row["conv_id"], BLOCK if new else block.most + BLOCK)
                        block.add(row["turn"], row["role"], row["text"], copies, fault)
                    if held >= BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist(ready, BLOCK_ROWS)
                        ready, held = [], 0
        if block is not None:
            ready.append(block.as_row(part, number))
        if ready:
            yield pa.RecordBatch.from_pylist(ready, BLOCK_ROWS)

    return ordered.mapInArrow(run, BLOCKS)


# ------------------------------------------------------------------ program


CONVERSATIONS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "checkpoints array<struct<part:int,block:long,after:array<long>,last:boolean>>"
)


def _conversations(blocks: DataFrame) -> DataFrame:
    """Per conversation its counts, its cost and the checkpoint after each block."""
    slim = [c for c in blocks.columns if c not in ("conv_id", "rows", "codes", "copies")]
    listed = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "block", *[c for c in slim if c not in ("part", "block")]))).alias("blocks"))
    schema = pa.schema([
        *[(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("checkpoints", pa.list_(pa.struct([("part", pa.int32()), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())]))),
    ])

    def one(conv_id: int | None, parts: list[dict]) -> dict:
        out = {k: sum(b[k] for b in parts) for k in ("blank", "duplicate", "truncated", "illegal")}
        turns = sum(b["turns"] for b in parts)
        for b, c in zip(parts, parts[1:]):
            out["illegal"] += b["last"] + c["first"] not in ("su", "ua", "au")
            turns -= b["greatest"] is not None and b["greatest"] == c["least"]
        seen = [b for b in parts if b["least"] is not None]
        gaps = seen[-1]["greatest"] - seen[0]["least"] + 1 - turns if seen else 0
        after, checkpoints = FINAL, []
        for b in reversed(parts):
            checkpoints.append({"part": b["part"], "block": b["block"], "after": after, "last": b is parts[-1]})
            after = costs_before([b["matrix"][k : k + 4] for k in range(0, 16, 4)], after)
        return out | {"conv_id": conv_id, "gaps": gaps, "cost": after[START], "checkpoints": checkpoints}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256).to_pylist()
                yield pa.RecordBatch.from_pylist([one(r["conv_id"], r["blocks"]) for r in rows], schema)

    return listed.mapInArrow(run, CONVERSATIONS)


def _walks(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """part, block, ends and audits of each block's four walks."""
    points = conversations.select(F.inline("checkpoints"))
    codes = blocks.select("conv_id", "part", "block", "codes", "copies")
    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("ends", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(lo, 256).to_pylist():
                    ends, audits = walk(list(r["codes"]), r["copies"], r["after"], r["last"])
                    out.append({"conv_id": r["conv_id"], "part": r["part"], "block": r["block"], "ends": ends, "audits": audits})
                yield pa.RecordBatch.from_pylist(out, schema)

    return codes.join(points, ["part", "block"]).mapInArrow(run, "conv_id long, part int, block long, ends array<int>, audits array<string>")


def _chosen(walks: DataFrame) -> DataFrame:
    """part, block, start (state) and audit of the walk that each block takes."""
    listed = walks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "block", "ends"))).alias("blocks"))
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(batch.num_rows):
                out, state = [], START
                for b in batch.column("blocks").slice(lo, 1).to_pylist()[0]:
                    out.append({"part": b["part"], "block": b["block"], "start": state})
                    state = b["ends"][state]
                yield pa.RecordBatch.from_pylist(out, schema)

    each = listed.select("blocks").mapInArrow(run, "part int, block long, start int")
    return walks.join(each, ["part", "block"]).select("part", "block", "start", F.get("audits", F.col("start")).alias("audit"))


EDITS = "conv_id long, part int, block long, place long, edit string, times int, turn long, role string, text string"


def _edits(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("place", pa.int64()), ("edit", pa.string()),
        ("times", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ])

    def edits_of(r: dict) -> list[dict]:
        out, state, row, codes = [], r["start"], 0, r["codes"]
        letters = iter(r["audit"])
        for letter in letters:
            at = {"conv_id": r["conv_id"], "part": r["part"], "block": r["block"], "place": len(out), "edit": letter, "times": 1}
            if letter == INSERT:
                state, role = DUE[state]
                out.append(at | {"turn": None, "role": role, "text": ""})
                continue
            new = dict(r["rows"][row])
            if codes[row] == FORCED:
                at["times"] = r["copies"][row]
                for _ in range(at["times"] - 1):
                    next(letters)
            elif letter == KEEP:
                state = keep_state(codes[row], state)
            elif letter == REROLE:
                state, new["role"] = DUE[state]
            out.append(at | new)
            row += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(batch.num_rows):
                out = edits_of(batch.slice(lo, 1).to_pylist()[0])
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    rows = blocks.select("conv_id", "part", "block", "codes", "copies", "rows")
    return rows.join(chosen, ["part", "block"]).mapInArrow(run, EDITS)


class Repaired(NamedTuple):
    """``edits``: conv_id, part, block, place (their order), edit (its initial),
    times (of equal deletions), and turn, role and text as they are after the edit
    (before it, for deletions). ``conversations``: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost."""

    edits: DataFrame
    conversations: DataFrame


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    blocks = materialize(_blocks(_ordered_rows(turns, conv_col, turn_col, role_col, text_col)))
    conversations = materialize(_conversations(blocks))
    walks = materialize(_walks(blocks, conversations))
    return Repaired(_edits(blocks, _chosen(walks)), conversations.drop("checkpoints"))


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation of ``edits``: conv_id, audit (all initials) and
    repaired_sha256, of its repaired ``role:text`` lines."""
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_, digest, letters, first, ready = None, False, None, [], True, []

        def done() -> dict:
            return {"conv_id": at, "audit": "".join(letters), "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    if not open_ or r["conv_id"] != at:
                        if open_:
                            ready.append(done())
                        at, open_, digest, letters, first = r["conv_id"], True, hashlib.sha256(), [], True
                    letters.append(r["edit"] * r["times"])
                    if r["edit"] != DELETE:
                        digest.update(f"{'' if first else chr(10)}{r['role']}:{r['text']}".encode())
                        first = False
                if len(ready) >= 1000:
                    yield pa.RecordBatch.from_pylist(ready, schema)
                    ready = []
        if open_:
            ready.append(done())
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    placed = edits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")
    return placed.select("conv_id", "edit", "times", "role", "text").mapInArrow(run, "conv_id long, audit string, repaired_sha256 string")
