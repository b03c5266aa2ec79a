"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    # As a view, like the driver: what cannot be one is no oracle.
    con.sql(sql).create_view("checked", replace=True)
    cur = con.execute("SELECT * FROM checked")
    return _rows([d[0] for d in cur.description], cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None if equal (exact floats), else a short account."""
    ours, theirs = spark_rows(df), duck_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    only = [r for r in ours[1] if r not in set(theirs[1])][:3]
    missing = [r for r in theirs[1] if r not in set(ours[1])][:3]
    return f"{len(ours[1])} rows != {len(theirs[1])} rows; only ours {only}; only theirs {missing}"


if __name__ == "__main__":
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    from __spark_entry__ import oracle_sql, queries
    from quotepanel.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = oracle_sql()
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                count = len(duck_rows(con, oracles[name])[1])
            else:
                problem, count = None, df.count()
        except Exception as error:  # report and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:400]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {count} rows {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
