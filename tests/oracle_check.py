"""Local twin of the driver's correctness gate: run each registered query in
Spark and its SQL twin in DuckDB on the same parquet tables, then compare row
count, column names and an order-insensitive multiset of row values.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return None
    try:
        import pandas as pd

        if v is pd.NaT:
            return None
    except Exception:  # noqa: BLE001
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return canon(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return str(v)


def rows_of(tbl):
    """Arrow table -> (sorted column names, multiset of canonical rows)."""
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    out = Counter()
    for rec in zip(*data):
        out[tuple(canon(x) for x in rec)] += 1
    return cols, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toArrow()
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=spdf.num_rows, spark_s=round(t1 - t0, 2), note="no oracle")
    dpdf = con.sql(sql).arrow()
    if hasattr(dpdf, "read_all"):
        dpdf = dpdf.read_all()
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    res = dict(name=name, rows=spdf.num_rows, oracle_rows=dpdf.num_rows, spark_s=round(t1 - t0, 2))
    if scols != dcols:
        res.update(ok=False, note=f"columns differ: spark-only {sorted(set(scols) - set(dcols))} "
                                  f"oracle-only {sorted(set(dcols) - set(scols))}")
        return res
    if srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        res.update(ok=False, note=f"values differ; cols={scols}\n  spark-only {only_s}\n  oracle-only {only_d}")
        return res
    stypes = {f.name: _family(f.type) for f in spdf.schema}
    dtypes = {f.name: _family(f.type) for f in dpdf.schema}
    diff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    res.update(ok=True, note=f"TYPES {diff}" if diff else "")
    return res


def _family(t):
    import pyarrow as pa

    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_null(t):
        return "null"
    return str(t)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from mercato.plans.session import build_session

    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001
            r = dict(name=name, ok=False, note=f"ERROR {type(exc).__name__}: {str(exc)[:600]}")
        flag = {True: "OK ", False: "BAD", None: "-- "}[r.get("ok")]
        bad += r.get("ok") is False
        print(f"{flag} {name:<28} rows={r.get('rows')} oracle={r.get('oracle_rows')} "
              f"t={r.get('spark_s')} {r.get('note', '')}", flush=True)
    print(f"done: {len(names or qs)} queries, {bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
