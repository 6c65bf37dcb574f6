"""A training-data pipeline over ``documents``.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns the documents it keeps, with their columns; the last returns packed
pieces. Each stage works on all its predecessor kept. ``run`` applies them in
order and writes every intermediate result to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import decontam, minmax, paragraphs, qda
from mercato.llm import queries as Q
from mercato.plans.session import materialize

#: Score from which the quality classifier calls a document good.
LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant (op6) accepts."""
    model = Q.quality_model(docs, Q.table(spark, sf_dir, "labels"))
    return qda.keep_good(docs, model, LEAST_QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate group (op8).

    Of rows that repeat id and text the least one stays, by its other columns; of
    rows of one id and different texts those stay that are kept; rows without an id
    all stay. Two rows of one id whose texts are near copies of each other both stay.
    """
    same = ["doc_id", "_text_hash"]
    kept = minmax.near_duplicates(docs).filter("kept and doc_id is not null").withColumnRenamed("text_hash", "_text_hash")
    named = docs.filter("doc_id is not null").withColumn("_text_hash", F.xxhash64("text"))
    found = named.join(kept.select(*same).distinct(), same, "left_semi")
    one = found.groupBy(*same).agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return one.unionByName(docs.filter("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated passages (op10); n_chars
    follows the text. A document that lost all its words goes."""
    same = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = paragraphs.dedup_paragraphs(docs, keep=same).filter("n_removed = 0 or n_removed < n_words")
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight (op4)."""
    found = decontam.decontaminate(docs, Q.table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    return found.filter(~F.col("contaminated")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens (op1)."""
    return Q.packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Trained models, component clustering and tokenisation are beyond SQL; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Q.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
