"""Run registered queries beside their SQL in DuckDB and compare rows by value."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.6g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    """None if equal, else a message."""
    df = fn(spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    cursor = con.execute(sql)
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns differ: {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"row counts differ: {len(got[1])} / {len(want[1])}"
    if not got[1]:
        return "no rows"
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if different:
        return f"{len(different)} of {len(want[1])} rows differ, columns {got[0]}: {different[:2]}"
    return None


def main(argv):
    import __spark_entry__ as entry
    from fingertrail.session import build_session
    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT_ROWS"):
        spark.conf.set("fingertrail.hotRows", os.environ["HOT_ROWS"])
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as error:  # a failing query must not hide the others
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += message is not None
        print(f"{name}: {'ok' if message is None else message} "
              f"({'sql' if name in oracles else 'rows'}, {time.time() - start:.1f}s)", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
