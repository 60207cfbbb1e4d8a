"""Run registered queries and their SQL side by side: ``python tests/compare.py [--shuffle] [folder] [name ...]``.

``--shuffle`` switches broadcasts off, as large tables would have it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return f"dec {v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _kind(v) -> str:
    return type(v).__name__


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """(problem or None, row count, seconds)"""
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, len(got), seconds
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(got), seconds
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"{len(got)} / {len(want)} rows; only ours {extra}; only sql {missing}", len(got), seconds
    for i, n in enumerate(df.columns):
        kinds = {_kind(r[i]) for r in got} - {"NoneType"}
        j = names.index(n)
        kinds_want = {_kind(r[j]) for r in want} - {"NoneType"}
        if kinds != kinds_want:
            return f"types of {n}: {kinds} / {kinds_want}", len(got), seconds
    return None, len(got), seconds


def main():
    import __spark_entry__ as e
    from starmart.session import local_session

    args = [a for a in sys.argv[1:] if a != "--shuffle"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8)
    if "--shuffle" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con = duck(sf_dir)
    sqls, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        try:
            problem, n, seconds = compare(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as ex:  # noqa: BLE001
            problem, n, seconds = f"{type(ex).__name__}: {str(ex)[:600]}", -1, 0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {seconds:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
