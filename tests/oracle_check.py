"""Run registered queries beside their DuckDB twins: python tests/oracle_check.py [sf] [name…]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(directory):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{directory}/{t}.parquet')")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(df, con, sql):
    """(equal, Spark rows, DuckDB rows, first difference)"""
    cursor = con.execute(sql)
    duck_columns = [d[0] for d in cursor.description]
    duck_rows = normal(cursor.fetchall(), duck_columns)
    spark_rows = normal(df.collect(), df.columns)
    if sorted(df.columns) != sorted(duck_columns):
        return False, spark_rows, duck_rows, (sorted(df.columns), sorted(duck_columns))
    if spark_rows == duck_rows:
        return True, spark_rows, duck_rows, None
    both = set(map(repr, spark_rows)) ^ set(map(repr, duck_rows))
    mine, theirs = set(map(repr, spark_rows)), set(map(repr, duck_rows))
    return False, spark_rows, duck_rows, ([r[:300] for r in sorted(both & mine)[:2]],
                                          [r[:300] for r in sorted(both & theirs)[:2]])


def main(argv):
    import __spark_entry__ as entry
    from tests.conftest import local_session
    sf = argv[0] if argv else "0.01"
    directory = f"/root/testdata/sf{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark, con = local_session(), duck(directory)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, directory)
            if name in oracles:
                equal, mine, theirs, diff = compare(df, con, oracles[name])
                result = f"{'ok  ' if equal else 'DIFF'} {len(mine)} / {len(theirs)}"
            else:
                equal, diff, result = True, None, f"rows {len(df.collect())}"
        except Exception as e:      # report and go on
            equal, diff, result = False, f"{type(e).__name__}: {str(e)[:800]}", "ERROR"
        print(f"{name:28s} {time.time() - start:6.1f}s {result}", flush=True)
        if not equal:
            failed.append(name)
            print("    ", diff, flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} fine; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
