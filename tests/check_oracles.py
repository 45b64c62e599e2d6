"""Compare every query with its SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, build, sql):
    df = build(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"{len(ours)} rows, no SQL", True
    con.execute(sql)
    names = [d[0] for d in con.description]
    theirs = rows_of(names, con.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(names)} / {sorted(df.columns)}", False
    if ours != theirs:
        a, b = set(ours), set(theirs)
        return f"{len(ours)} / {len(theirs)} rows; only ours {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}", False
    return f"{len(ours)} rows", True


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark, con = session(), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry_module.oracle_sql()
    bad = 0
    for name, build in entry_module.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            message, ok = compare(spark, con, folder, name, build, oracle.get(name))
        except Exception as error:  # report and go on with the next query
            message, ok = f"{type(error).__name__}: {str(error)[:600]}", False
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - began:5.1f}s {name}: {message}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
