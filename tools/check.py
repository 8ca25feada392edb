"""Compare queries with their SQL on one scale: ``python tools/check.py [--sf DIR] [name ...]``."""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from weftgraph.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = rows_of(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}\n   only here: {extra}\n   only there: {missing}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from weftgraph.queries import ORACLES, QUERIES

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name, fn in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, ORACLES.get(name), args.sf)
        except Exception as exc:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
