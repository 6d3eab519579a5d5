"""Run registered queries against their SQL in DuckDB and compare all rows exactly."""

from __future__ import annotations

import collections
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    relation = con.execute(sql)
    want_columns = [d[0] for d in relation.description]
    want = relation.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    order = sorted(want_columns)
    got = [tuple(r[c] for c in order) for r in df.collect()]
    at = [want_columns.index(c) for c in order]
    want = [tuple(r[i] for i in at) for r in want]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got_bag, want_bag = collections.Counter(got), collections.Counter(want)
    kinds = {(order[i], type(v)) for row in got_bag for i, v in enumerate(row) if v is not None}
    want_kinds = {(order[i], type(v)) for row in want_bag for i, v in enumerate(row) if v is not None}
    if kinds != want_kinds:
        return f"types {kinds ^ want_kinds}"
    if got_bag != want_bag:
        extra, lack = list((got_bag - want_bag).items()), list((want_bag - got_bag).items())
        return f"{len(extra)} rows differ, e.g. {order}: {sorted(extra, key=str)[:2]} != {sorted(lack, key=str)[:2]}"
    return None


def main() -> None:
    """python tests/compare.py SF_DIR [name part ...]"""
    sys.path.insert(0, str(ROOT))
    from __spark_entry__ import oracle_sql, queries
    from freightloom.session import build_session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls, bad = oracle_sql(), []
    for name, fn in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, fn, sqls[name])
            else:
                problem = None if fn(spark, sf_dir).collect() else "no rows"
        except Exception as error:  # report every query, not only the first bad one
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s"
              f"{'' if name in sqls else ' (no SQL)'} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
