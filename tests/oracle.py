"""Run registered queries beside their SQL and compare whole results.

python -m tests.oracle <table folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value: object) -> object:
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(ours) != len(theirs):
        return f"row counts {len(ours)} vs {len(theirs)}\n  ours   {ours[:2]}\n  theirs {theirs[:2]}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference of {len(ours)} rows ({sum(x != y for x, y in zip(ours, theirs))} differ)\n  ours   {a}\n  theirs {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types {[type(x).__name__ for x in a]} vs {[type(x).__name__ for x in b]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from dishframe.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), connect(folder)
    bad = 0
    sql = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, query, sql[name])
                n = con.execute(f"SELECT count(*) FROM ({sql[name]})").fetchall()[0][0]
            else:
                problem, n = None, len(query(spark, folder).collect())
        except Exception as error:  # report and go on to the next query
            problem, n = f"{type(error).__name__}: {str(error).splitlines()[0][:500]}", -1
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:28s} rows={n:<8} {time.time() - start:6.2f}s {'' if name in sql else '(rows only)'}", flush=True)
        if problem:
            print("    ", problem, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
