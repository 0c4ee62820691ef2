"""Run registered queries against DuckDB and report differences.

    python tests/crosscheck.py [sf_dir] [name-prefix …]
"""

from __future__ import annotations

import math
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, fn, sql, directory):
    began = time.time()
    df = fn(spark, directory)
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - began
    if sql is None:
        return True, len(got), spent, "no SQL twin"
    cursor = con.execute(sql)
    want_cols, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return False, len(got), spent, f"columns {got_cols} != {want_cols}"
    if got == want:
        return True, len(got), spent, ""
    extra = [r for r in got if r not in set(want)][:3] if len(got) < 50000 else got[:2]
    missing = [r for r in want if r not in set(got)][:3] if len(want) < 50000 else want[:2]
    return False, len(got), spent, f"rows {len(got)} vs {len(want)}; cols {got_cols}; only spark {extra}; only sql {missing}"


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    directory = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    import __spark_entry__ as entry

    spark, con = session(), duck(directory)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    names = [n for n in queries if not prefixes or n.startswith(prefixes)]

    def check(name):
        try:
            return compare(spark, con.cursor(), name, queries[name], oracles.get(name), directory)
        except Exception as exc:  # report every failing query, then go on
            return False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:600]}"

    with ThreadPoolExecutor(4) as pool:
        outcomes = list(pool.map(check, names))
    for name, (ok, rows, spent, note) in zip(names, outcomes):
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:45s} rows={rows:<7d} {spent:5.1f}s {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
