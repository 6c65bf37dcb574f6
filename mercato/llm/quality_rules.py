"""Quality rules: base rules and a hashed n-gram likelihood ratio [native].

Words and word pairs of a text are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted from whole texts: one over the trusted
target (documents labelled good), one over the raw corpus (all documents). A
document's score is the mean, over its words and pairs, of the logarithm of the
target probability over the raw probability. A document is kept when it passes
the base rules and its score reaches a fixed threshold; nothing is drawn at
random.

Everything is DataFrame functions. The counts are summed per task before they
are shuffled, so a hot source or bucket costs one row per task; the table of log
ratios has ``buckets`` numbers and is a literal of the scoring plan.

Arrays that lambdas read are passed through a one-row ``inline``, which keeps
the optimizer from copying their definition into the lambda (that would evaluate
it once per element).

Defined cases: a null or wordless text has no words, fails the base rules and
scores 0; without any trusted document all scores are 0; several labels of a
document count with the smallest; repeated rows are scored alike; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
THRESHOLD = -0.07
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

# Characters between words, and characters counted as symbols.
SPACE_CLASS, SPACES = r"[^\x20\x09-\x0D]+", " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that later lambdas may read at no cost."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_hashes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``h``, the hashes of the words of the whole text."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SPACE_CLASS), F.lit(0))
    return _held(docs, h=F.transform(words, lambda w: F.xxhash64(w)))


def _grams(buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbouring words of ``h``."""
    one = "transform(h, x -> cast(pmod(x, {b}L) as int))"
    two = "transform(h, (x, i) -> cast(pmod(xxhash64(x, get(h, i + 1)), {b}L) as int))"
    return F.expr(f"concat({one}, if(size(h) > 1, slice({two}, 1, size(h) - 1), array()))".format(b=buckets))


def base_statistics(hashed: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    whole = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    windows = F.expr(
        f"if(size(h) >= {WINDOW}, transform(slice(h, 1, size(h) - {WINDOW - 1}), (x, i) -> xxhash64(x, "
        + ", ".join(f"get(h, i + {k})" for k in range(1, WINDOW))
        + ")), array())"
    )
    df = _held(hashed, _lines=lines, _windows=windows)
    # only texts with a repeated window need the sort
    df = _held(
        df,
        _sorted=F.expr(
            "if(size(array_distinct(_windows)) < size(_windows), "
            "sort_array(transform(_windows, (x, i) -> struct(x as w, i as i))), array())"
        ),
    )
    starts = (
        "sort_array(transform(filter(_sorted, (p, k) -> "
        "coalesce(get(_sorted, k - 1).w = p.w, false) or coalesce(get(_sorted, k + 1).w = p.w, false)), p -> p.i))"
    )
    covered = (
        f"aggregate({starts}, struct(0 as upto, 0L as total), (a, i) -> struct(i + {WINDOW} as upto, "
        f"a.total + (i + {WINDOW} - greatest(a.upto, i)) as total), a -> a.total)"
    )
    return df.select(
        *hashed.columns,
        F.size("h").cast("long").alias("n_words"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
    )


def bucket_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", buckets: int = BUCKETS
) -> DataFrame:
    """bucket, raw (n-grams of all documents), target (of trusted documents)."""
    trusted = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .filter("label = 1")
        .select("doc_id", F.lit(1).alias("trusted"))
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter(
        "text is not null"
    )
    # rows without an id have no label; they stay out of the join and can't crowd one task
    # a merge join at every size: labels grow with the documents and are never broadcast
    marked = rows.filter("doc_id is not null").join(trusted.hint("merge"), "doc_id", "left").select("text", "trusted")
    marked = marked.unionByName(rows.filter("doc_id is null").select("text", F.lit(None).cast("int").alias("trusted")))
    grams = with_hashes(marked).select(F.explode(_grams(buckets)).alias("bucket"), "trusted")
    return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log of the smoothed target over the smoothed raw probability, by bucket."""
    totals = counts.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    ratio = F.log((F.col("target") + 1) / (F.col("all_target") + buckets)) - F.log(
        (F.col("raw") + 1) / (F.col("all_raw") + buckets)
    )
    every = counts.withColumn("one", F.lit(1)).join(totals.withColumn("one", F.lit(1)), "one")
    out = [0.0] * buckets
    for r in every.select("bucket", F.when(F.col("all_target") > 0, ratio).otherwise(0.0).alias("v")).collect():
        out[r.bucket] = r.v  # at most ``buckets`` rows
    return out


def score(
    docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: doc_id, the base statistics, base_failed, score, kept."""
    buckets = len(ratios)
    table = F.split(F.lit(",".join(f"{v:.6g}" for v in ratios)), ",").cast("array<double>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    df = base_statistics(with_hashes(rows))
    df = _held(df, _g=_grams(buckets))
    total = F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.get(table, g))
    df = df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words").alias("base_failed"),
        F.when(F.size("_g") > 0, total / F.size("_g")).otherwise(0.0).alias("score"),
    )
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
