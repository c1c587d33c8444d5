"""Compare queries with their SQL in DuckDB: ``python tests/oracle.py <sf_dir> [names]``."""

import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return round(value, 6)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(
        (tuple(_plain(r[n]) for n in names) for r in df.collect()), key=lambda t: repr(t)
    )


def duck_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    rows = [tuple(_plain(r[i]) for i in places) for r in cursor.fetchall()]
    return names, sorted(rows, key=lambda t: repr(t))


def difference(spark, sf_dir, function, sql):
    """'' when both sides agree, else a short account."""
    names, ours = spark_rows(function(spark, sf_dir))
    their_names, theirs = duck_rows(sf_dir, sql)
    if names != their_names:
        return f"columns {names} / {their_names}"
    if ours == theirs:
        return ""
    left = [r for r in ours if r not in set(theirs)][:2]
    right = [r for r in theirs if r not in set(ours)][:2]
    return f"rows {len(ours)} / {len(theirs)}; ours {left}; theirs {right}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from conftest import make_session

    from __spark_entry__ import oracle_sql, queries

    session, bad = make_session("local[8]"), 0
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            found = difference(session, sys.argv[1], queries()[name], oracle_sql()[name])
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(found)
        print(f"{name:32s} {time.time() - start:6.1f}s {found[:2500] or 'ok'}", flush=True)
    print("failed:", bad)
