"""Compare registered queries with their SQL twins: python -m tests.compare [sf] [name part ...]"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return value + 0.0  # -0.0 and 0.0 are equal
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def duck(root: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    return con


def compare(spark, con, name: str, root: str) -> str:
    """'' when equal, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, root)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return "" if mine else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = canonical(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        left = sorted(set(mine) - set(theirs), key=str)[:2]
        right = sorted(set(theirs) - set(mine), key=str)[:2]
        return f"rows {len(mine)} / {len(theirs)}; only here {left}; only there {right}"
    return "" if mine else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lakeops.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    root = f"/root/testdata/sf{sf}"
    spark, con = local_session(), duck(root)
    bad = 0
    for name in queries():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, root)
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        mark = "ok " if not problem else "BAD"
        print(f"{mark} {time.time() - start:6.1f}s {'sql ' if name in oracle_sql() else 'rows'} {name} {problem}", flush=True)
    print("failures:", bad)
