"""Run registered queries and their DuckDB texts side by side and compare whole results.

    python tests/parity.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
         "conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for view in VIEWS:
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return ("dec", format(value, "f"))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def result_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    left_cols, left = result_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right_cols, right = result_rows(names, cursor.fetchall())
    if left_cols != right_cols:
        return f"columns differ: {left_cols} / {right_cols}"
    if left != right:
        only_left, only_right = list((left - right).items())[:3], list((right - left).items())[:3]
        return (f"rows differ: {sum(left.values())} / {sum(right.values())}, "
                f"{sum((left - right).values())} only in Spark\n  spark {only_left}\n  duck  {only_right}")
    return None if left else "empty"


def main(argv):
    from queries.registry import all_queries
    from tidemill.session import local_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at:at + 2]
    spark = local_session(8)
    con = duck_connection(sf)
    bad = 0
    for name, (build, sql) in all_queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            df = build(spark, sf)
            problem = compare(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        fine = problem is None or problem.startswith("rows only")
        bad += not fine
        print(f"{'ok ' if fine else 'BAD'} {name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
