"""Compare a registered query with its SQL over the same parquet tables.

Run as a script: ``python tests/compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, name, query, sql, sf_dir):
    """An empty string when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = _sorted(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = _sorted([c[0] for c in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if not want:
        return "the SQL gives no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"columns {got_columns}\n  spark {str(g)[:600]}\n  sql   {str(w)[:600]}"
    return ""


def main(argv):
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry

    from tradeloom.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        sql = entry.oracle_sql().get(name)
        start = time.time()
        try:
            problem = compare(spark, con, name, query, sql, sf_dir) if sql else f"rows only: {query(spark, sf_dir).count()}"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(problem and sql)
        print(f"{name:32s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1:])
