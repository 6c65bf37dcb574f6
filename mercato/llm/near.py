"""Links between near-duplicate sets, and their connected components.

``near_components`` takes banded signatures of nodes (distinct sets) and finds
the components of all pairs that share a band key and have a Jaccard similarity
of at least ``least`` percent, confirmed on the full sets.

It never lists all pairs of a bucket. In every round each open bucket names a
few pivots, and a pivot is compared with the members of the bucket that are not
yet in its component; then it leaves the bucket, having met all of it. A bucket
is open while its members lie in two components. Pivots are the members with the
most links so far, each of another component; the rounds name 1, 1 and MOST_PIVOTS
of them. The first round uses FIRST_BANDS bands only. It joins most of a group of
copies, so the further bands find little left to compare, and such a group costs a
few comparisons a member.

What is open after the rounds (variants of one text that went too far from it and
from each other) is compared once, by what its members do not share with their
pivot, one for all buckets of like pivots (``_fewer_pivots``): similar sets of two components must share one of the rarer of these items
(``_differences``), so pairs are met by those items, not by the bucket. No
bucket is capped and no pair lost.

Two bounds spare comparisons without losing a link. Items that no other open
member has can't be shared, so a member whose other items are too few for the
limit leaves its bucket (variants of one text that went too far from it). And a
pair goes to the full sets only if 128 sketch values agree well enough: SLACK is
five standard deviations under the limit.

Everything is joins and aggregates; hot buckets are aggregated partially and
their joins can be split by AQE. Band keys and items are counted as blobs
(``buckets``). Links, components and sets stay distributed.
Tables used several times are stored in the shared folder and read back, and
deleted when the next round's stand: so no plan computes one twice, and plans stay
short. The driver holds all stages and tasks of a running plan, and those that can
start run at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.buckets import bucket_bits, by_bucket, flushes, meeting, numbers, schema, whole_buckets
from mercato.llm.text import mix
from mercato.plans.session import discard, materialize

#: Bits of the filter that tasks use to skip what can't be asked for; its size
#: is fixed, so that it can be sent to every task (4 MB).
FILTER_BITS = 1 << 25


def _slots(keys: np.ndarray, bits: int = FILTER_BITS) -> list[np.ndarray]:
    k = keys.astype(np.int64).view(np.uint64)
    return [(mix(k ^ np.uint64(seed)) & np.uint64(bits - 1)).astype(np.int64) for seed in (0x51ED27, 0xA24BAED, 0x9E6C63)]


@contextmanager
def plain_plans(spark: SparkSession) -> Iterator[None]:
    """Plans without inferred constraints: many small joins are planned here, and
    inferring them is much of the time that takes."""
    name = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """At most one task per ``each`` of a known number of rows: a stage of many
    nearly empty tasks writes several files a task."""
    out = df.coalesce(max(1, -(-rows // each)))
    if hasattr(df, "_mercato_path"):
        out._mercato_path = df._mercato_path
    return out


def merged_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A sort-merge join at every size. These tables grow with the input, and a
    broadcast of each small one would pass through the driver in every round."""
    return left.join(right.hint("merge"), on, how)


class KeyFilter:
    """A Bloom filter of ``bits`` bits (a power of two) over a column of long keys;
    null never passes. ``release`` frees it in the driver and the executors."""

    def __init__(self, keys: DataFrame, bits: int = FILTER_BITS) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield filter_words(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits)

        self._fill(keys.toDF("key").mapInArrow(run, FILTER_WORDS), bits)

    @classmethod
    def of_words(cls, words: DataFrame, bits: int) -> KeyFilter:
        """From rows of ``filter_words``."""
        out = cls.__new__(cls)
        out._fill(words, bits)
        return out

    def _fill(self, words: DataFrame, bits: int) -> None:
        self.bits, table = bits, np.zeros(bits >> 6, np.uint64)
        merged = few(words.groupBy("word").agg(F.bit_or("bits").alias("bits")), bits >> 6).toArrow()  # at most bits / 64 rows
        table[merged["word"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
        self.table = words.sparkSession.sparkContext.broadcast(table)

    def release(self) -> None:
        self.table.destroy()

    def passes(self, keys: pa.Array) -> np.ndarray:
        table = self.table.value
        ok = keys.is_valid().to_numpy(zero_copy_only=False)
        values = keys.fill_null(0).to_numpy(zero_copy_only=False)
        for slot in _slots(values, self.bits):
            ok = ok & ((table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
        return ok


FILTER_WORDS = "word long, bits long"


def filter_words(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """The 64-bit words of a Bloom filter that have bits of these keys."""
    slots = np.unique(np.concatenate(_slots(keys, bits)))
    words, first = np.unique(slots >> 6, return_index=True)
    set_bits = np.left_shift(np.uint64(1), (slots & 63).astype(np.uint64))
    merged = np.bitwise_or.reduceat(set_bits, first) if len(first) else set_bits
    return pa.RecordBatch.from_arrays([pa.array(words), pa.array(merged.view(np.int64))], names=["word", "bits"])


def repeated_filter(rows: DataFrame, values_of: Callable[[pa.RecordBatch], np.ndarray], n: int, most_bits: int = FILTER_BITS) -> KeyFilter:
    """A filter that every 64-bit hash passes which ``values_of`` finds more than
    once in ``rows``; ``n`` is how many it finds about. Hashes meet as blobs."""
    bits, filter_bits = bucket_bits(n), min(1 << max(16, n.bit_length()), most_bits)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (values,) in flushes([values_of(batch)] for batch in batches):
            hashes, times = np.unique(values, return_counts=True)
            yield by_bucket(hashes, bits, {"hash": hashes, "twice": times > 1})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            hashes, twice = numbers(table["hash"], "<u8")[0], numbers(table["twice"], "?")[0]
            order = np.argsort(hashes)
            hashes, twice = hashes[order], twice[order]
            twice[1:] |= hashes[1:] == hashes[:-1]
            yield filter_words(hashes[twice].view(np.int64), filter_bits)

    met = meeting(rows.mapInArrow(dealt, schema("hash", "twice")), n)
    return KeyFilter.of_words(met.mapInArrow(words, FILTER_WORDS), filter_bits)


def counted(df: DataFrame, condition: str = "true") -> tuple[DataFrame, int]:
    """``df`` stored and read back, and how many of its rows fulfil the
    condition, counted in the same job."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count_if(F.expr(condition)).alias("n")))
    return out, int(seen.get["n"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected links (a, b); the root is the
    smallest node of the component.

    Every round each root that still has a link hooks onto its smallest
    neighbour, the hooks are followed to their ends by doubling, and the links are
    contracted to those roots. At least half of the roots with a link vanish, so a
    component of n nodes takes at most log2(n) rounds; a chain of hooks of length
    d takes log2(d) doublings, two of them a job.
    """
    with plain_plans(links.sparkSession):
        return _components(links)


def _followed(parent: DataFrame, n: int) -> DataFrame:
    """(a, p) with every p replaced by the end of its chain of hooks."""
    moved = 1
    while moved:
        before, upper = parent, parent.select(F.col("a").alias("p"), F.col("p").alias("upper"))
        once = few(merged_join(parent, upper, "p").select("a", F.col("upper").alias("p")), n)
        upper = once.select(F.col("a").alias("p"), F.col("p").alias("upper"))
        twice = merged_join(once, upper, "p").select("a", F.col("upper").alias("p"), (F.col("upper") < F.col("p")).alias("moved"))
        seen = Observation()
        parent = materialize(few(twice, n).observe(seen, F.count_if("moved").alias("n")).drop("moved"))
        moved = int(seen.get["n"])
        discard(before)
    return parent


def _components(links: DataFrame) -> DataFrame:
    links, n = counted(links.select("a", "b").filter("a <> b").distinct())
    label, total = None, n
    while n or label is None:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(few(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), 2 * n))
        parent = _followed(hooks, 2 * n)
        old_label, old_links = label, links
        if label is None:
            label = parent.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            label = relabelled(label, parent.select(F.col("a").alias("node"), F.col("p").alias("root")))
        label = materialize(few(label, 2 * total))
        ends = merged_join(links, parent, "a").select(F.col("p").alias("x"), F.col("b").alias("a"))
        ends = few(merged_join(few(ends, n), parent, "a"), n)
        links = ends.select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b")).filter("a <> b").distinct()
        links, n = counted(few(links, n))
        discard(parent, old_label, old_links)
    discard(links)
    return label


def relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` with every ``root`` that ``merged`` knows as a node replaced by
    that node's root."""
    new = merged.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    return merged_join(rows, new, "root", "left").withColumn("root", F.coalesce("_new", "root")).drop("_new").select(*rows.columns)


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` hash functions."""
    values = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return values[:n] | np.uint64(1), values[n:]


#: Bands that the first round compares by.
FIRST_BANDS = 4

#: Pivots that a bucket names in the last round; what is open then is compared by
#: differences from its first one.
MOST_PIVOTS = 4

#: Percent of similarity from which one pivot stands for another there.
LIKE = 50

#: Functions of a sketch (a minimum and a maximum each), and how far under the
#: limit its estimate may be.
SKETCH, SLACK = 64, 0.2


def with_sketch(sets: DataFrame) -> DataFrame:
    """node, items and the top 16 bits of SKETCH minima and maxima."""
    factors, offsets = permutations(SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                first = np.cumsum(np.r_[0, part.column(1).value_lengths().to_numpy(zero_copy_only=False)])[:-1]
                out = np.zeros((part.num_rows, 2 * SKETCH), np.uint16)
                for k in range(SKETCH):
                    y = (flat + offsets[k]) * factors[k]
                    out[:, 2 * k] = np.minimum.reduceat(y, first) >> np.uint64(16)  # low bits: the top ones are all alike
                    out[:, 2 * k + 1] = np.maximum.reduceat(y, first) >> np.uint64(16)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in out], pa.binary())], names=["node", "items", "sketch"]
                )

    return sets.select("node", "items").filter(F.size("items") > 0).mapInArrow(run, "node long, items array<long>, sketch binary")


def similar_pairs(pairs: DataFrame, sets: DataFrame, least: int, n: int = 1 << 40) -> DataFrame:
    """The pairs (a, b, and the roots of both; ``n`` of them) whose sets have
    100 * intersection >= least * union."""
    each = 2_000

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, 2 * SKETCH) for i in ("a_sketch", "b_sketch"))
                ok = (one == two).mean(axis=1) >= least / 100 - SLACK
                yield batch.select(["a", "b", "a_root", "b_root"]).filter(pa.array(ok))

    close = pairs
    if "sketch" in sets.columns:
        one = sets.select(F.col("node").alias("a"), F.col("sketch").alias("a_sketch"))
        two = sets.select(F.col("node").alias("b"), F.col("sketch").alias("b_sketch"))
        sketched = merged_join(few(merged_join(pairs, one, "a"), n, each), two, "b").select("a", "b", "a_root", "b_root", "a_sketch", "b_sketch")
        close = few(sketched, n, each).mapInArrow(likely, "a long, b long, a_root long, b_root long")
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("a_items"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("b_items"))
    shared = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - shared
    met = few(merged_join(few(merged_join(close, one, "a"), n, each), two, "b"), n, each)
    return met.filter(100 * shared >= least * union).select("a", "b", "a_root", "b_root")


def _open(rows: DataFrame, least: int) -> DataFrame:
    """Members of buckets with two components, but for those that have too few
    items in common with others to link even with the smallest member."""
    buckets = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("size").alias("smallest"))
    members = merged_join(rows, buckets.filter("lo < hi").select("key", "smallest"), "key")
    return members.filter(f"{100 + least} * common >= {least} * (size + smallest)").drop("smallest")


def _pair(a: str, a_root: str, b: str, b_root: str):
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(a_root).alias("a_root"), F.col(b_root).alias("b_root"))


def _lonely_items(live: DataFrame, sets: DataFrame, n_sets: int) -> DataFrame:
    """node and the number of its items that no other open node has."""
    n_items = 64 * n_sets  # about
    bits = bucket_bits(n_items)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                items = batch.column(1)
                yield [mix(items.flatten().to_numpy().view(np.uint64)), np.repeat(batch.column(0).to_numpy(), items.value_lengths().to_numpy())]

        for items, nodes in flushes(parts()):
            items, first, times = np.unique(items, return_index=True, return_counts=True)
            yield by_bucket(items, bits, {"item": items, "node": nodes[first], "alone": times == 1})

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[list[np.ndarray]]:
            for table in whole_buckets(batches):
                items, nodes, once = (numbers(table[c], t)[0] for c, t in (("item", "<u8"), ("node", "<u8"), ("alone", "?")))
                order = np.argsort(items)
                items, nodes, once = items[order], nodes[order], once[order]
                same = items[1:] == items[:-1]
                once[1:] &= ~same
                once[:-1] &= ~same
                yield [nodes[once]]

        for (nodes,) in flushes(parts()):
            nodes, n = np.unique(nodes, return_counts=True)
            yield by_bucket(nodes, bits, {"node": nodes, "n": n.astype(np.int32)})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            nodes, row = np.unique(numbers(table["node"], "<i8")[0], return_inverse=True)
            n = np.bincount(row, numbers(table["n"], "<i4")[0], len(nodes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(n)], names=["node", "lonely"])

    items = merged_join(live.select("node").distinct(), sets.select("node", "items"), "node").mapInArrow(dealt, schema("item", "node", "alone"))
    lonely = meeting(items, n_items).mapInArrow(alone, schema("node", "n"))
    return meeting(lonely, n_items).mapInArrow(added, "node long, lonely int")


def _fewer_pivots(live: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """``pivots`` (key, p) with like pivots replaced by one of them, so that a member
    of many buckets differs from a few pivots, not from one in every bucket.

    Every member votes for that of its pivots that has the most members; a pivot gives
    way to the greatest that its members vote for, if their similarity is at least
    LIKE percent. Members stay about as near to the new pivot as to their own.
    """
    members = materialize(merged_join(live.select("key", "node"), pivots, "key").select("p", "node").distinct())
    weight = members.groupBy("p").agg(F.count("*").alias("n"))
    ranked = materialize(merged_join(members, weight, "p"))
    votes = ranked.groupBy("node").agg(F.max(F.struct("n", "p")).alias("h"))
    votes, n = counted(merged_join(ranked, votes, "node").filter("h.p <> p").select("p", "h").distinct())
    asked = few(votes.select("p", "h", F.col("h.p").alias("hub")), n)
    asked = merged_join(asked, sets.select(F.col("node").alias("p"), F.col("items").alias("p_items")), "p")
    asked = merged_join(asked, sets.select(F.col("node").alias("hub"), F.col("items").alias("hub_items")), "hub")
    shared = F.size(F.array_intersect("p_items", "hub_items"))
    like = asked.filter(100 * shared >= LIKE * (F.size("p_items") + F.size("hub_items") - shared))
    best = materialize(like.groupBy("p").agg(F.max("h").alias("h")).select("p", F.col("h.p").alias("hub")))
    out = materialize(merged_join(pivots, best, "p", "left").select("key", F.coalesce("hub", "p").alias("p")))
    discard(members, ranked, votes, best)
    return out


def _differences(live: DataFrame, pivots: DataFrame, sets: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """p, item, node, root, out (not the pivot's root), g, left: items by which the
    members of the buckets of a pivot ``p`` can be met. Any two members of different
    roots that are similar, not both to the pivot, have one in common for which
    ``left`` of both is at least g + g. And the links (a, b) of roots of members that
    are similar to the pivot and not of its root.

    ``live`` has key, node and root, ``pivots`` one pivot ``p`` a key and its root.
    Let s(x) be the items that only one of x and the pivot has, and g(x) their number
    less (100 - least) / (100 + least) of the size of x. Two sets are similar exactly
    if their s have at least (g(x) + g(y)) / 2 items in common. All that are similar to
    the pivot have its root or are linked with it here, so a pair of two roots has one
    that is not, and the bound is positive. So both have a common item with at least
    that many of their s from it on, in any one order. In the order of how many members
    share them, rarest first, few members share such an item, however many there are.
    """
    unlike, both = 100 - least, 100 + least
    members = merged_join(live.select("key", "node", "root"), pivots.select("key", "p", "p_root"), "key").filter("node <> p")
    members = members.select("p", "p_root", "node", "root", (F.col("root") != F.col("p_root")).alias("out"))
    met = members = materialize(members.distinct())
    roots = members.groupBy("p").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("out").alias("out"))
    split = roots.filter("out").select("p", F.expr("lo < hi").alias("several"))
    asked = materialize(merged_join(members, split, "p"))
    members = merged_join(asked, sets.select("node", "items"), "node")
    members = merged_join(members, sets.select(F.col("node").alias("p"), F.col("items").alias("p_items")), "p")
    other = F.concat(F.array_except("items", "p_items"), F.array_except("p_items", "items"))
    sizes = F.size("items").alias("size"), F.size("p_items").alias("p_size")
    members = members.select("p", "p_root", "node", "root", "out", "several", *sizes, other.alias("s"))
    members = materialize(members.withColumn("g", both * F.size("s") - unlike * F.col("size")))
    discard(met, asked)
    least_g = members.groupBy("p").agg(F.min("g").alias("any_g"), F.min(F.when(F.col("out"), F.col("g"))).alias("out_g"))
    items = members.filter("several").select("p", "node", "root", "out", "g", F.explode("s").alias("item"))
    shared = items.groupBy("p", "item").agg(F.count("*").alias("n"), F.count_if("out").alias("n_out")).filter("n > 1 and n_out > 0")
    shared, least_g = materialize(shared), materialize(least_g)
    items = merged_join(merged_join(items, shared, ["p", "item"]), least_g, "p")
    order = Window.partitionBy("p", "node").orderBy(F.desc(F.col("n") * F.col("n_out")), F.desc("item"))
    items = items.withColumn("left", 2 * both * F.row_number().over(order))  # itself and those after it
    items = items.filter(F.col("left") >= F.col("g") + F.when(F.col("out"), F.col("any_g")).otherwise(F.col("out_g")))
    out = materialize(items.select("p", "item", "node", "root", "out", "g", "left"))
    close = members.filter(f"out and g <= {unlike} * p_size")
    links = materialize(close.select(F.least("root", "p_root").alias("a"), F.greatest("root", "p_root").alias("b")).distinct())
    discard(members, shared, least_g)
    return out, links


def _differing_pairs(items: DataFrame, hubs: bool) -> tuple[DataFrame, int]:
    """Pairs (a, b, and their roots), and their number, of different roots that an
    item of ``_differences`` brings together: with ``hubs`` of the two members next to the
    pivot, one of its root and one of another, with all; else of all."""
    one, columns = items, ["node", "root", "out", "g", "left"]
    if hubs:
        near = F.min(F.struct("g", "node", "root", "left")).alias("x")
        one = items.groupBy("p", "item", "out").agg(near).select("p", "item", "out", "x.*")
    one = one.select("p", "item", *[F.col(c).alias(f"x_{c}") for c in columns])
    two = items if hubs else items.filter("out")
    once = "(out or x_out)" if hubs else "(not x_out or x_node < node)"
    met = merged_join(one, two, ["p", "item"]).filter(f"root <> x_root and {once} and least(`left`, x_left) >= g + x_g")
    pair = F.when(F.col("node") < F.col("x_node"), _pair("node", "root", "x_node", "x_root")).otherwise(_pair("x_node", "x_root", "node", "root"))
    pairs, n = counted(met.select(pair.alias("x")).select("x.*").distinct())
    return few(pairs, n), n


def near_components(
    nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], least: int = 75, sketch: bool = True
) -> DataFrame:
    """(node, root) of all nodes that share a bucket; the root is the smallest
    node of the component.

    ``nodes``: node (long), size (of its set), keys (array of long, one a band),
    one row per distinct node. ``sets_of`` gets the nodes in question (a column
    ``node``) and returns node and items (array of long, distinct) for at least
    those. Without ``sketch``, pairs are confirmed on the full sets only: for sets
    that are hardly longer than a sketch.
    """
    with plain_plans(nodes.sparkSession):
        return _near_components(nodes, sets_of, least, sketch)


def _near_components(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], least: int, sketch: bool) -> DataFrame:
    n_keys = nodes.select(F.sum(F.size("keys"))).first()[0] or 0
    known = repeated_filter(nodes.select("keys"), lambda batch: batch.column(0).flatten().to_numpy().view(np.uint64), n_keys)

    def of_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = pc.list_parent_indices(batch.column(2))
            band = np.arange(len(row)) - np.searchsorted(row.to_numpy(), row.to_numpy())
            flat = pa.RecordBatch.from_arrays(
                [batch.column(2).flatten(), batch.column(0).take(row), batch.column(1).take(row), pa.array(band.astype(np.int32))],
                names=["key", "node", "size", "band"],
            )
            yield flat.filter(pa.array(known.passes(flat.column(0))))

    maybe = nodes.select("node", F.col("size").cast("int"), "keys").mapInArrow(of_shared, "key long, node long, size int, band int")
    maybe, n = counted(maybe)
    maybe = few(maybe, n)
    known.release()
    shared = maybe.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members, size = counted(few(merged_join(maybe, shared, "key"), n))
    members = few(members, size)
    discard(maybe)
    sets = sets_of(members.select("node").distinct())
    sets = few(sets, size, 20_000)
    sets, n_sets = counted(with_sketch(sets) if sketch else sets.select("node", "items").filter(F.size("items") > 0))
    sets = few(sets, n_sets, 5_000)
    label = sets.select("node", F.col("node").alias("root"))
    stored, degree, live, lonely, open_sets = [members, sets], None, None, None, None
    members = members.withColumn("common", F.col("size"))
    rows = members.filter(F.col("band") < FIRST_BANDS).withColumn("root", F.col("node")).withColumn("links", F.lit(0))
    rows = rows.select("key", "node", "size", "common", "root", "links")
    pivots_each, last_bands = 1, False
    while True:
        # ``rows`` are members that were no pivots of their bucket yet
        before = live
        once = _open(rows, least)
        if lonely is not None:  # as members left, buckets may have closed
            once = materialize(few(once, size))
        live, n = counted(few(once if lonely is None else _open(once, least), size))
        live = few(live, n)
        discard(before, rows, once)
        if not n and last_bands:
            discard(*stored, live, lonely, degree)
            return label
        if last_bands and lonely is None:
            lonely = materialize(_lonely_items(live, sets, n_sets))
            rows = merged_join(live, lonely, "node", "left").withColumn("common", F.col("size") - F.coalesce("lonely", F.lit(0))).drop("lonely")
            rows = materialize(few(rows, size))
            continue
        if lonely is not None and open_sets is None:
            # from here on members only leave, and most have
            open_sets, n_open = counted(merged_join(sets, live.select("node").distinct(), "node", "left_semi"))
            discard(sets)
            sets = open_sets = few(open_sets, n_open, 5_000)
            stored.append(sets)
        if pivots_each > MOST_PIVOTS:
            pivots = few(_fewer_pivots(live, met_all, sets), size)
            items, links = _differences(live, merged_join(pivots, label.toDF("p", "p_root"), "p"), sets, least)
            stored += [pivots, items, links]
            for hubs in (True, False):
                pairs, n = _differing_pairs(items, hubs)
                found = similar_pairs(pairs, sets, least, n).select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
                found = materialize(found.unionByName(links) if hubs else found)
                merged = components(found)
                old_label, label = label, materialize(few(relabelled(label, merged), n_sets))
                stored += [pairs, found, merged, old_label]
                if hubs:
                    old_items, items = items, materialize(relabelled(items, merged))
                    discard(old_items)
                    stored.append(items)
            discard(*stored, live, lonely, degree, met_all)
            return label
        by_links = [F.desc("links"), F.xxhash64("node"), "node"]
        heads = live.withColumn("k", F.row_number().over(Window.partitionBy("key", "root").orderBy(*by_links))).filter("k = 1")
        pivots = heads.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy(*by_links))).filter(F.col("k") <= pivots_each)
        pivots = pivots.select(
            "key", F.col("node").alias("p"), F.col("root").alias("p_root"), F.col("size").alias("p_size"), F.col("common").alias("p_common"), "k"
        )
        pivots, n_pivots = counted(few(pivots, n))
        pivots = few(pivots, n_pivots)
        met = merged_join(live, pivots, "key").filter(
            f"root <> p_root and 100 * least(size, p_size) >= {least} * greatest(size, p_size) "
            f"and {100 + least} * least(common, p_common) >= {least} * (size + p_size)"
        )
        ours, theirs = ("node", "root"), ("p", "p_root")
        pair = F.when(F.col("node") < F.col("p"), _pair(*ours, *theirs)).otherwise(_pair(*theirs, *ours))
        pairs, n = counted(few(met.select(pair.alias("x")).select("x.*").distinct(), n * pivots_each))
        pairs = few(pairs, n)
        found, n = counted(similar_pairs(pairs, sets, least, n))
        found = few(found, n)
        if n or degree is None:
            ends = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").cast("int").alias("links"))
            old_degree, old_label = degree, label
            if degree is not None:
                ends = ends.unionByName(degree).groupBy("node").agg(F.sum("links").cast("int").alias("links"))
            degree = materialize(few(ends, n_sets))
            merged = components(found.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")))
            label = materialize(few(relabelled(label, merged), n_sets))
            discard(old_degree, old_label, merged)
        discard(found, pairs)
        if last_bands:
            rows = merged_join(live.drop("root", "links"), pivots.select("key", F.col("p").alias("node")), ["key", "node"], "left_anti")
            if pivots_each == MOST_PIVOTS:
                met_all = materialize(few(pivots.filter("k = 1").select("key", "p"), size))
            pivots_each *= 4
        else:
            rows, last_bands = members.select("key", "node", "size", "common"), True
        rows = merged_join(merged_join(rows, label, "node"), degree, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
        rows = materialize(few(rows.select("key", "node", "size", "common", "root", "links"), size))
        discard(pivots)
