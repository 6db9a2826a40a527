"""Run queries against their SQL twins: same columns, kinds, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return "decimal", v
    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v.isoformat() if isinstance(v, dt.date) else v


def rows_of(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    theirs = rows_of(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"{name}: {len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        only_a, only_b = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        return f"{name}: {len(only_a)} of {len(mine)} rows differ, e.g.\n   {sorted(df.columns)}\n   {(only_a or ['-'])[0][:1500]}\n   {(only_b or ['-'])[0][:1500]}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = make_session(), database(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, con, name, fn, oracle_sql()[name], sf_dir)
            else:
                df = fn(spark, sf_dir)
                rows = df.collect()
                problem = None if rows else f"{name}: no rows"
                if wanted:
                    print(df.columns, rows[:6])
        except Exception as e:  # a report over all queries
            problem = f"{name}: {type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '}{name} {time.time() - start:.1f}s {'' if name in oracle_sql() else '(rows only)'}" + (f"\n  {problem}" if problem else ""), flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
