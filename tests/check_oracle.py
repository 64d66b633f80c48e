"""Run every query and its SQL side by side: ``python tests/check_oracle.py [sf_dir] [name,name]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from spinneret.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, name, query, sql, sf_dir):
    """None if both give the same rows, else a text that says how they differ."""
    started = time.time()
    got = query(spark, sf_dir)
    columns = sorted(got.columns)
    mine = normal(got.select(*columns).collect())
    spark_time = time.time() - started
    started = time.time()
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    rows = found.fetchall()
    at = [names.index(c) for c in columns]
    theirs = normal([tuple(r[i] for i in at) for r in rows])
    print(f"{name:20s} rows {len(mine):8d} {len(theirs):8d} spark {spark_time:6.2f}s sql {time.time() - started:6.2f}s", flush=True)
    if mine != theirs:
        left, right = set(mine) - set(theirs), set(theirs) - set(mine)
        return f"{len(left)} rows only here {sorted(map(str, left))[:3]}, {len(right)} only there {sorted(map(str, right))[:3]}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name, query in queries().items():
        if name not in oracle_sql() or only and name not in only:
            continue
        try:
            problem = compare(spark, con, name, query, oracle_sql()[name], sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        if problem:
            failures += 1
            print(f"{name:20s} DIFFERS: {problem}", flush=True)
    print(f"{failures} differences")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
