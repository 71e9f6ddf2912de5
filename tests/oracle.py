"""Run registered queries on Spark and their SQL twins on DuckDB and compare the rows.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(con, spark_df, sql: str) -> str:
    """Empty text when both agree, otherwise the first differences."""
    cols, rows = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    ocols, orows = _rows([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} != {ocols}"
    if len(rows) != len(orows):
        return f"{len(rows)} rows != {len(orows)} rows"
    for a, b in zip(rows, orows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            differing = sum(x != y for x, y in zip(rows, orows))
            return f"{differing} rows differ, first {cols}: {a} != {b}"
    return ""


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from farmledger.session import local_session

    directory = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(directory)
    all_queries, sqls = queries(), oracle_sql()
    names = argv[1:] or list(all_queries)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = all_queries[name](spark, directory)
            if name in sqls:
                message = compare(con, df, sqls[name])
            else:
                message = f"(no oracle, {df.count()} rows)"
        except Exception as error:  # report and go on
            message = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = message == "" or message.startswith("(no oracle")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.2f}s {message}", flush=True)
    print(f"{len(names)} queries, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(1 if main(sys.argv[1:]) else 0)
