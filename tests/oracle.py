"""Compare registered queries with their SQL twins in DuckDB.

Run as a script: ``python tests/oracle.py [folder] [name-prefix ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and value == 0.0:
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    rel = con.execute(sql)
    columns = [c[0] for c in rel.description]
    return canonical(columns, rel.fetchall())


def differences(got, want):
    """Empty when equal, else a short description."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if repr(g) != repr(w)]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else ""


def main(argv):
    import __spark_entry__ as contract
    from loomstat.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = contract.oracle_sql()
    failed = []
    for name, fn in contract.queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, folder))
            took = time.time() - start
            note = differences(got, sql_rows(con, oracle[name])) if name in oracle else "no twin"
            state = "ok" if note in ("", "no twin") else "DIFF"
        except Exception as error:  # report and go on
            took, state, note = time.time() - start, "ERROR", f"{type(error).__name__}: {str(error)[:700]}"
            got = ([], [])
        if state != "ok":
            failed.append(name)
        print(f"{state:5} {name:32} {took:6.2f}s {len(got[1]):7} rows {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
