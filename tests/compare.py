"""Run registered queries in Spark and their SQL in DuckDB and compare values.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings \
pages benchmark labels conversations".split()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return repr(float(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    """``None`` when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "BOOLEAN": "boolean"}
    expected = dict(zip(rel.columns, (kinds.get(str(t), str(t)) for t in rel.types)))
    if expected != dict(df.dtypes):
        return f"types {dict(df.dtypes)} != {expected}"
    want = rows(rel.columns, rel.fetchall())
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return f"{len(got)} rows, expected {len(want)}; {str(diff)[:1500]}"
    return None


def main():
    from conftest import make_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con, oracles = make_session(), duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, query, oracles.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        kind = "values" if name in oracles else "rows"
        print(f"{name:28s} {time.time() - start:6.1f}s {kind} {problem or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
