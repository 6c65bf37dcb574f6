"""Key joins that keep NULL-key groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = True
) -> DataFrame:
    """Equi-join two frames on same-named ``keys``, keeping left's key columns.

    ``null_safe`` matches NULL to NULL (a NULL group on both sides is the
    same group). With keys known to be non-NULL, pass ``null_safe=False``: a
    plain equi-join keeps the sides' hash partitioning on the keys and lets
    Catalyst drop a unique right side whose columns are unused.
    """
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, how)
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
