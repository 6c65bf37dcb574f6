"""Exact grouped median without sending a whole group to one task.

``percentile``/``median`` merge every distinct value of a group in one task;
with one group holding a third of all rows, that task holds a third of the
distinct values. Here the work is split into bounded steps:

1. count rows per (group, bucket of ``width`` units) straight from the rows —
   partial aggregation leaves one row per bucket and task;
2. a running sum over the buckets of one group finds the bucket(s) that hold the
   middle ranks;
3. a second pass over the one value column keeps only rows of those buckets,
   counts their distinct values (shuffled by value too, so a hot group spreads)
   and a running sum picks the middle value(s).

Values are compared as given, without rounding; NULL and NaN are skipped. The
result interpolates like ``MEDIAN``: the mean of the two middle values for an
even count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.money import money_avg, present
from mercato.plans.joins import join_on_keys


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str = "median",
    shift: int = 16,
    width: float | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Per-group exact median of the numeric column ``value``.

    Buckets are ``width`` wide (default ``2**shift``). Returns ``keys + [out]``
    (double), one row per group with a value. Group keys may be NULL (matched
    null-safely). A row stands for ``weight`` equal ones where that column is named.
    """
    keys = list(keys)
    v = present(value)
    bucket = F.floor(v / F.lit(float(2**shift if width is None else width))).cast("long")
    times = [F.col(weight).alias("_w")] if weight else []
    rows = df.where(v.isNotNull()).select(*keys, bucket.alias("_b"), v.alias("_v"), *times)
    counted = F.sum("_w") if weight else F.count(F.lit(1))

    # steps 1 and 2: cumulative counts over the buckets of each group
    running = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    coarse = (
        rows.groupBy(*keys, "_b")
        .agg(counted.alias("_bc"))
        .withColumns({"_hi": F.sum("_bc").over(running), "_n": F.sum("_bc").over(whole)})
    )
    # middle ranks (n+1) div 2 and n div 2 + 1 (one rank when n is odd), as
    # the rank inside the bucket that holds them
    k = F.explode(F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1)))
    targets = (
        coarse.select(*keys, "_b", "_bc", "_hi", k.alias("_k"))
        .where((F.col("_hi") - F.col("_bc") < F.col("_k")) & (F.col("_k") <= F.col("_hi")))
        .select(*keys, "_b", (F.col("_k") - F.col("_hi") + F.col("_bc")).cast("long").alias("_kb"))
    )

    # step 3: only the target buckets' values, one window partition per
    # (group, bucket, target rank)
    fine_w = Window.partitionBy(*keys, "_b", "_kb").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        join_on_keys(rows, targets, keys + ["_b"], how="inner")
        .groupBy(*keys, "_b", "_kb", "_v")
        .agg(counted.alias("_c"))
        .withColumn("_hi2", F.sum("_c").over(fine_w))
        .where((F.col("_hi2") - F.col("_c") < F.col("_kb")) & (F.col("_kb") <= F.col("_hi2")))
    )
    return picked.groupBy(*keys).agg(money_avg("_v").alias(out))
