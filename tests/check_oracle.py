"""Run queries next to their SQL in DuckDB and compare: ``python tests/check_oracle.py SF_DIR [key ...]``."""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        return repr(float(f"{v:.9g}") + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return [cell(x) for x in v]
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(str([cell(r[i]) for i in order]) for r in rows)
    return [columns[i] for i in order], body


def compare(spark, con, sf, key, fn, sql):
    t = time.time()
    df = fn(spark, sf)
    got = df.collect()
    took = time.time() - t
    sc, sb = canon(df.columns, [tuple(r) for r in got])
    if sql is None:
        return took, len(got), "rows-only", ""
    cur = con.sql(sql)
    dc, db = canon(cur.columns, cur.fetchall())
    if sc != dc:
        return took, len(got), "COLUMNS", f"{sc} vs {dc}"
    if len(sb) != len(db):
        return took, len(got), "ROWS", f"{len(sb)} vs {len(db)}"
    if sb != db:
        a, b = set(sb), set(db)
        return took, len(got), "VALUES", f"\n   spark {sorted(a - b)[:2]}\n   duck  {sorted(b - a)[:2]}"[:1500]
    return took, len(got), "ok", hashlib.md5("".join(sb).encode()).hexdigest()[:6]


def main():
    import duckdb
    from tests.sessions import session

    import __spark_entry__ as entry

    sf, keys = sys.argv[1], sys.argv[2:]
    spark = session()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or queries:
        try:
            took, n, verdict, note = compare(spark, con, sf, key, queries[key], oracles.get(key))
        except Exception as e:  # noqa: BLE001
            took, n, verdict, note = 0, 0, "ERROR", str(e)[:1200]
        bad += verdict not in ("ok", "rows-only")
        print(f"{verdict:9s} {key:32s} rows={n:<7d} {took:6.2f}s {note}", flush=True)
    print(f"{len(keys or queries)} queries, {bad} bad, {len(oracles)} oracles of {len(queries)}")


if __name__ == "__main__":
    main()
