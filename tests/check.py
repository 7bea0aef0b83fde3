"""Compare registered queries with their DuckDB statements: python tests/check.py [names]."""

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from oncallmart import session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(norm(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), v) for v in r),
    )


def compare(spark, db, name, folder):
    started = time.time()
    frame = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in frame.collect()]
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"rows only: {len(got)}", took
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(set(columns) ^ set(frame.columns))}", took
    a, b = rows_of(frame.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} != {len(b)}", took
    for x, y in zip(a, b):
        if x != y:
            cols = sorted(columns)
            bad = [(c, p, q) for c, p, q in zip(cols, x, y) if p != q]
            return False, f"{bad[:4]} in row {x[:6]}", took
        kinds = [
            (type(p), type(q)) for p, q in zip(x, y) if p is not None and type(p) is not type(q)
        ]
        if kinds:
            return False, f"types {kinds[:3]}", took
    return True, f"{len(a)} rows equal", took


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    spark = session.build("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db = duck(folder)
    failed = []
    for name in args or entry.queries():
        try:
            ok, note, took = compare(spark, db, name, folder)
        except Exception as error:  # keep going, report at the end
            ok, note, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {took:6.2f}s  {note}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
