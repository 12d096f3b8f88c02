"""Run registered queries next to their SQL and compare rows without regard to order."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def run_pair(spark, con, fn, sql, folder, inspect=None):
    start = time.time()
    df = fn(spark, folder)
    if inspect:
        inspect(df)
    got = normal(df.columns, df.collect())
    spark_s, start = time.time() - start, time.time()
    cur = con.execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    return got, want, spark_s, time.time() - start


def main(argv):
    sys.path.insert(0, str(ROOT))
    from jobstrata.checks import REGISTRY
    from jobstrata.session import build_session

    folder, names = argv[0], argv[1:]
    spark = build_session(master="local[8]", **{"spark.driver.memory": "16g", "spark.ui.enabled": "false",
                                                "spark.sql.shuffle.partitions": "8",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name, (fn, sql) in REGISTRY.items():
        if names and not any(n in name for n in names):
            continue
        try:
            if sql is None:
                start = time.time()
                n = fn(spark, folder).count()
                print(f"rows  {name}: {n} rows, {time.time() - start:.1f}s", flush=True)
                continue
            got, want, a, b = run_pair(spark, con, fn, sql, folder)
            same = got == want
            print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got[1])} rows, spark {a:.1f}s sql {b:.1f}s", flush=True)
            if not same:
                print("   ", got[0], want[0], len(got[1]), len(want[1]))
                left, right = set(got[1]), set(want[1])
                print("    spark only", [r for r in got[1] if r not in right][:3])
                print("    sql only  ", [r for r in want[1] if r not in left][:3])
        except Exception as e:  # report and go on with the next query
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
