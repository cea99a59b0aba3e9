"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, connection, sf_dir: str, run, sql: str) -> str | None:
    frame = run(spark, sf_dir)
    left = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    right = canonical(names, result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[1] != right[1]:
        only_left = sorted(set(left[1]) - set(right[1]))[:3]
        only_right = sorted(set(right[1]) - set(left[1]))[:3]
        return f"rows {len(left[1])} / {len(right[1])}\n   spark {only_left}\n   sql   {only_right}"
    if not left[1]:
        return "no rows"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from papyrine.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            if name in oracles:
                problem = difference(spark, connection, sf_dir, queries[name], oracles[name])
            else:
                count = queries[name](spark, sf_dir).count()
                problem = None if count else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("failed:", failed, "of", len(names))
    return failed


if __name__ == "__main__":
    sys.exit(main())
