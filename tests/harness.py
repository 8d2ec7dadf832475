"""Compare a registered query with its DuckDB SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def make_session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, bool) or value is None:
        return ("b", repr(value))
    if isinstance(value, int):
        return ("i", repr(value))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value.normalize()))
    if isinstance(value, (dt.datetime, dt.date)):
        return ("t", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("l", tuple(plain(v) for v in value))
    return ("s", str(value))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(plain(r[i]) for i in order) for r in rows
    )


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    rel = con.sql(sql)
    return normal(list(rel.columns), rel.fetchall())


def check(spark, con, query, folder):
    from tidemill.catalog import Tables

    begin = time.time()
    got_cols, got = spark_result(query.build(Tables(spark, folder)))
    took = time.time() - begin
    if query.sql is None:
        return None, len(got), took
    want_cols, want = duck_result(con, query.sql)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", len(got), took
    if got != want:
        only = [r for r in got if r not in set(want)][:3]
        miss = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}; extra {only}; missing {miss}", len(got), took
    return None, len(got), took


def main(argv):
    """``python -m tests.harness [-s sf] prefix...`` prints one line per query."""
    import traceback

    from tidemill.catalog import load_all

    sf = "0.01"
    if argv[:1] == ["-s"]:
        sf, argv = argv[1], argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = make_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duck(folder)
    bad = 0
    for name, q in sorted(load_all().items()):
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            problem, rows, took = check(spark, con, q, folder)
        except Exception as exc:  # report and go on
            problem, rows, took = f"{type(exc).__name__}: {str(exc)[:600]}", -1, 0
            if "-v" in os.environ.get("HARNESS", ""):
                traceback.print_exc()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} rows={rows} {took:.1f}s "
              f"{'' if q.sql else '(rows only) '}{problem or ''}"[:1500], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
