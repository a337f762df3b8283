"""Run registered queries beside their SQL twins and compare the rows.

    python tests/compare.py FOLDER [PREFIX ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def kind(value):
    return "int" if isinstance(value, int) and not isinstance(value, bool) else type(value).__name__


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when equal, else what differs first."""
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not got:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; e.g. {next((a for a, b in zip(got, want) if a != b), None)} / {next((b for a, b in zip(got, want) if a != b), None)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b or [kind(v) for v in a] != [kind(v) for v in b]]
    return f"{len(bad)} of {len(got)} rows: {bad[0][0]} != {bad[0][1]}" if bad else None


if __name__ == "__main__":
    from tallyloom.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    folder, *wanted = sys.argv[1:]
    con = connect(folder)
    failed = 0
    for name in entry.queries():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{name:34s} {time.time() - begin:6.2f}s  {problem or 'ok'}", flush=True)
    print("failed", failed)
