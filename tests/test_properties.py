"""Property-based checks: exact money aggregation and the bucket rules
against plain-Python statements of the same rules."""

from __future__ import annotations

import math
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.functions import rules
from mercato.functions.money import money_avg, money_sum

cents_lists = st.lists(st.integers(min_value=-10**11, max_value=10**11), min_size=1, max_size=200)


@settings(max_examples=20, deadline=None)
@given(cents_lists, st.integers(min_value=1, max_value=7))
def test_money_sum_is_exact_under_any_partitioning(spark, cents, parts):
    df = spark.createDataFrame([(c / 100.0,) for c in cents], "x double").repartition(parts)
    row = df.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).collect()[0]
    exact = sum(Decimal(c) / 100 for c in cents)
    assert row.s == float(exact)
    assert row.a == float(exact) / len(cents)


def rain_py(p, null_policy):
    if p is None:
        if null_policy == "no_rain":
            p = 0.0
        else:
            return "Heavy Rain"
    if p == 0:
        return "No Rain"
    if p < 5:
        return "Light Rain"
    return "Heavy Rain"


def temp_py(t):
    if t is not None and not math.isnan(t) and t >= 30:
        return "Hot"
    if t is not None and not math.isnan(t) and t >= 22:
        return "Warm"
    return "Cool"


values = st.lists(st.one_of(st.none(), st.floats(min_value=-50, max_value=80, allow_nan=False)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(values)
def test_bucket_rules_match_plain_python(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select(
        rules.rain_category("v", "heavy").alias("h"),
        rules.rain_category("v", "no_rain").alias("n"),
        rules.temp_category("v").alias("t"),
    ).collect()
    assert [(r.h, r.n, r.t) for r in got] == [(rain_py(v, "heavy"), rain_py(v, "no_rain"), temp_py(v)) for v in vals]


groups = st.dictionaries(
    st.sampled_from(["a", "b", "c", "d"]),
    st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=80),
    min_size=1, max_size=4,
)


@settings(max_examples=10, deadline=None)
@given(groups, st.integers(min_value=0, max_value=20), st.integers(min_value=1, max_value=5))
def test_exact_median_property(spark, data, shift, parts):
    import statistics

    from mercato.functions.median import exact_median

    rows = [(k, v) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v long").repartition(parts)
    got = {r.k: r.median for r in exact_median(df, ["k"], "v", shift=shift).collect()}
    assert got == {k: float(statistics.median(vs)) for k, vs in data.items()}
