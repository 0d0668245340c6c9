"""Run registered queries and their DuckDB equivalents side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    done = con.execute(sql)
    return [c[0] for c in done.description], done.fetchall()


def _key(row: tuple):
    return tuple((v is not None, str(type(v)), v) for v in row)


def differences(left, right) -> list[str]:
    """What differs between (columns, rows) pairs; row order does not matter."""
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return [f"columns {lc} / {rc}"]
    if len(lr) != len(rr):
        return [f"rows {len(lr)} / {len(rr)}"]
    out = []
    for a, b in zip(sorted(lr, key=_key), sorted(rr, key=_key)):
        for name, x, y in zip(lc, a, b):
            same = x == y or (
                isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)
            )
            if not same or type(x) is not type(y):
                out.append(f"{name}: {x!r} / {y!r} in {a}")
    return out


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries
    from hourwatt.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("PLAIN"):  # a session that was not built for this package
        spark = SparkSession.builder.master("local[8]").config(
            "spark.ui.enabled", "false"
        ).config("spark.driver.memory", "8g").getOrCreate()
    else:
        spark = build_session(
            master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
        )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            took = time.time() - start
            if name not in sql:
                print(f"rows  {name:36} {len(got[1]):6} rows {took:6.2f}s")
                continue
            found = differences(got, duck_rows(con, sql[name]))
            state = "ok" if not found else "DIFF"
            print(f"{state:5} {name:36} {len(got[1]):6} rows {took:6.2f}s")
        except Exception as problem:
            found = [" ".join(str(problem).splitlines()[:6])[:900]]
            print(f"FAIL  {name}")
        bad += bool(found)
        for line in found[:3]:
            print("      ", line[:600])
    print("bad:", bad)


if __name__ == "__main__":
    main()
