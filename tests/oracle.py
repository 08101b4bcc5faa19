"""Compare catalogue queries with their SQL on DuckDB: row counts, columns and values."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, bool) or value is None:
        return str(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(spark, sf_dir, query, sql, con):
    """``None`` when both give the same rows, else a description."""
    frame = query(spark, sf_dir)
    got = _bag(frame.columns, frame.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = _bag(names, answer.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only here {list(extra)[:2]}, only there {list(lacking)[:2]}"
        )
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_points

    from quayside.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:]
    session = local_session(8)
    con = connect(folder)
    oracles = entry_points.oracle_sql()
    failed = 0
    for name, run in entry_points.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = difference(session, folder, run, oracles[name], con)
            else:
                problem = None
                print(name, "rows", run(session, folder).count())
        except Exception as err:
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}")
    print("failed:", failed)
