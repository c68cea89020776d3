"""Compare registered queries with DuckDB: ``python -m tests.compare [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([normal(r[i]) for i in order] for r in rows), key=repr)


def difference(spark_df, connection, sql):
    """None when both sides agree, else a short description."""
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def main(folder="/root/testdata/sf0.01", *names):
    from __spark_entry__ import oracle_sql, queries
    from asphalt.session import local_session

    spark, connection = local_session(8), connect(folder)
    asked, sql, bad = queries(), oracle_sql(), 0
    for name in names or asked:
        start = time.time()
        try:
            frame = asked[name](spark, folder)
            if name in sql:
                problem = difference(frame, connection, sql[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # shown and counted
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(names or asked)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
