"""Near-duplicate documents by min-max hashing.

The set of a document is its distinct shingles of five lower-cased words. Each
of PERMUTATIONS hash functions is evaluated once per shingle and gives two
signature values, the minimum and the maximum, so half the evaluations yield an
unbiased estimate of lower variance. Bands of four values (two functions) are
bucket keys; at a similarity of 0.75 a pair shares none of the 32 bands with
probability (1 - 0.75**4)**32, about 5e-6. Links are confirmed on the full sets.

Documents of one set are one node. The sets of nodes that share a bucket are
made again from the text by a second scan, behind a filter of fixed size, so
texts are not shuffled.

Defined cases: a null text or one without words has an empty set and is linked
with nothing; fewer than five words make one shingle; a document without an id
is linked with nothing and has a null component (kept); repeated rows are linked
like any copies; other columns are not read. Shingles and sets are compared by
55-bit and 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.near import KeyFilter, merged_join, near_components, permutations
from mercato.llm.text import LOWER, SET_ROWS, list_array, mix, set_ids, shingle_sets, small_batches, text_chunks
from mercato.plans.session import materialize

SHINGLE, LEAST = 5, 75
PERMUTATIONS, BANDS = 64, 32


def band_keys(items: np.ndarray, first: np.ndarray, n: int = PERMUTATIONS, bands: int = BANDS) -> np.ndarray:
    """Bucket keys (rows x bands) of non-empty sets."""
    rows, per_band = len(first) - 1, n // bands
    keys = np.zeros((rows, bands), np.uint64)
    factors, offsets = permutations(n)
    for k in range(n):
        y = (items + offsets[k]) * factors[k]
        low, high = np.minimum.reduceat(y, first[:-1]), np.maximum.reduceat(y, first[:-1])
        band = k // per_band
        keys[:, band] = mix(mix(keys[:, band] + low) + high + np.uint64(band + 1))
    return keys


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, buf, offs in text_chunks(texts, most_rows=SET_ROWS):
        items, first = shingle_sets(LOWER[buf], offs, SHINGLE)
        yield lo, hi, items, first


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, size (of the set), node (hash of the set), keys (of its bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, items, first in _sets(batch.column(1)):
                n = np.diff(first)
                some = n > 0
                keys = np.zeros((0, BANDS), np.uint64)
                if some.any():
                    keys = band_keys(items, np.r_[first[:-1][some], len(items)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        pa.array(n.astype(np.int32)),
                        pa.array(set_ids(items, first)),
                        list_array(keys.ravel(), np.concatenate([[0], np.cumsum(some * BANDS)])),
                    ],
                    names=["doc_id", "text_hash", "size", "node", "keys"],
                )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, size int, node long, keys array<long>")


def sets_of_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """node and items of (at least) the documents with these ids."""
    wanted = KeyFilter(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.filter(pa.array(wanted.passes(batch.column(0)))).column(1)
            for _, _, items, first in _sets(texts):
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(items, first)), list_array(items, first)], names=["node", "items"])

    return docs.mapInArrow(run, "node long, items array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable over
    links of at least ``least`` percent similarity), kept (is that id), text_hash
    (xxhash64 of the text, which tells rows of one id apart)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(signatures(docs))
    named = rows.filter("size > 0 and doc_id is not null")
    nodes = materialize(named.groupBy("node").agg(F.min("doc_id").alias("smallest"), F.min("size").alias("size")))
    distinct = materialize(named.select("node", "size", "keys").dropDuplicates(["node"]))

    def sets_of(wanted: DataFrame) -> DataFrame:
        return sets_of_documents(docs, merged_join(wanted, nodes, "node").select("smallest")).dropDuplicates(["node"])

    roots = near_components(distinct, sets_of, least)
    rooted = merged_join(nodes, roots, "node", "left").select("node", "smallest", F.coalesce("root", "node").alias("root"))
    least_id = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    component = merged_join(rooted, least_id, "root").select("node", "component_id")
    # rows of empty sets or without an id stand alone and stay out of the join
    joined = merged_join(named, component, "node").select("doc_id", "text_hash", "size", "component_id")
    alone = rows.filter("not (size > 0 and doc_id is not null)").select("doc_id", "text_hash", "size", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_hash",
    )
