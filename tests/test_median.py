"""Distributed exact median vs brute force, including a hot group."""

from __future__ import annotations

import random
import statistics

import pytest

from mercato.functions.median import exact_median


@pytest.mark.parametrize("shift", [0, 3, 16])
def test_exact_median_matches_brute_force(spark, shift):
    rng = random.Random(7)
    rows = []
    # a hot group with a third of all rows, small groups, a NULL-key group,
    # odd and even counts, negatives and NULL values
    for _ in range(3000):
        rows.append(("hot", rng.randint(-500, 5000)))
    for g in range(40):
        for _ in range(rng.randint(1, 60)):
            rows.append((f"g{g}", rng.randint(0, 300)))
    rows += [(None, 5), (None, 8), ("nulls", None), ("nulls", 4)]
    rows += [("even", 1), ("even", 2), ("even", 9), ("even", 10)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    got = {r.k: r.median for r in exact_median(df, ["k"], "v", shift=shift).collect()}

    expected = {}
    for k in {r[0] for r in rows}:
        vals = [v for kk, v in rows if kk == k and v is not None]
        if vals:
            expected[k] = float(statistics.median(vals))
    assert got == expected


def test_exact_median_multiple_keys(spark):
    rows = [(y, m, v) for y in (2017, 2018) for m in (1, 2) for v in range(y + m, y + m + 11)]
    df = spark.createDataFrame(rows, "y int, m int, v long")
    got = {(r.y, r.m): r.median for r in exact_median(df, ["y", "m"], "v", shift=2).collect()}
    assert got == {(y, m): float(y + m + 5) for y in (2017, 2018) for m in (1, 2)}
