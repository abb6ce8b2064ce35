"""Run registered queries next to their SQL and compare values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def compare(spark, sf: str, run, sql: str, con) -> str | None:
    """None when equal, else a description of the difference."""
    df = run(spark, sf)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: {got[:2]} {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {[b for b in bad if b[0]!=b[1]][:2] or bad[:2]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from brightloom.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session()
    con = duck(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or queries:
        if not any(name == q for q in queries):
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = compare(spark, sf, queries[name], sqls[name], con)
            else:
                n = len(queries[name](spark, sf).collect())
                diff = None if n else "no rows"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.1f}s {'' if name in sqls else '(rows)'} {diff or ''}", flush=True)
        if diff:
            failed.append(name)
    print("failed:", failed)
