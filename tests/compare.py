"""Run named queries in Spark and their checks in DuckDB on the same files and compare.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value) if value != int(value) else int(value)
    if isinstance(value, float):
        return int(value) if value == int(value) else round(value, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(cell(r[i]) for i in order)) for r in rows)


def compare(spark, con, name, fn, sql, sf):
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canon(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if not got:
        return None if not want else f"no rows, expected {len(want)}"
    if got != want:
        left, right = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; only spark {sorted(left)[:2]}; only sql {sorted(right)[:2]}"
    return None


def main() -> int:
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    fns, sqls = e.queries(), e.oracle_sql()
    for name in names or fns:
        t = time.time()
        try:
            problem = compare(spark, con, name, fns[name], sqls.get(name), sf)
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
