"""Run queries and their SQL side by side; usage: check_oracles.py SF [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


def plain(value):
    """A value both engines print alike."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return 0.0 if number == 0 else number
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:19]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, query, sql):
    """None when equal, else a short description."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            bad = sum(1 for x, y in zip(got, want) if x != y)
            return f"{bad} of {len(got)} rows differ, first {a} != {b}"
    return None


def main():
    from salesweft.session import build_session
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        began = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, query, sql[name])
            else:
                problem = None if query(spark, folder).count() > 0 else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    missing = set(sql) - set(entry.queries())
    print("failed:", failed, "sql without query:", missing)


if __name__ == "__main__":
    main()
