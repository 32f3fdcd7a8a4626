"""Runs registered queries and their SQL side by side.

Usage: python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, dict):
        return str({k: plain(v) for k, v in value.items()})
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None where both sides agree, else the first difference."""
    found = df.collect()
    mine = sorted_rows(df.columns, [tuple(r) for r in found])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = sorted_rows(names, cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    different = [(a, b) for a, b in zip(mine[1], theirs[1]) if repr(a) != repr(b)]
    if different:
        return f"{len(different)} of {len(mine[1])} rows differ: {different[0]}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from contraluz.session import local_session
    spark = local_session(8)
    con, queries, sqls = duck(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                note = f"{df.count() if problem else ''}"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:900]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s "
              f"{problem or ''} {note}", flush=True)
    for name in sqls:
        if name not in queries:
            print("no query for", name)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01",
                  arguments[1:]))
