"""Runs a registered query and its SQL side by side: python tests/oracle.py [sf] [name part ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}".replace("-0.000000", "0.000000")
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, folder: str) -> str:
    """Empty when equal, else what differs."""
    df = query.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if query.sql is None:
        return "" if got else "no rows"
    want = con.sql(query.sql)
    if sorted(df.columns) != sorted(want.columns):
        return f"columns {sorted(df.columns)} against {sorted(want.columns)}"
    a, b = rows_of(df.columns, got), rows_of(want.columns, want.fetchall())
    if not a:
        return "no rows"
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"rows {len(a)}/{len(b)} spark only {only_a} sql only {only_b}"[:1500]


if __name__ == "__main__":
    from __spark_entry__ import QUERIES
    from weftwork.session import get_spark

    sf, parts = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = get_spark(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.weftwork.inputPartitions": "8",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        kind = "rows" if query.sql is None else "sql"
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - start:.1f}s {problem}", flush=True)
    print("failures", bad)
