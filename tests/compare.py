"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: [(v is None, str(type(v)), str(v)) for v in row]
    return sorted(([plain(row[i]) for i in order] for row in rows), key=key)


def difference(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when both agree, else what differs."""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; first got {got[:2]}, expected {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"got {a}, expected {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from embedlift.workspace import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = build_session("compare", "8", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf)
    sqls = contract.oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for query_name, function in contract.queries().items():
        if wanted and not any(query_name == w or (w.endswith("*") and query_name.startswith(w[:-1])) for w in wanted):
            continue
        begun = time.time()
        try:
            result = difference(session, database, sf, function, sqls[query_name]) if query_name in sqls else (
                None if function(session, sf).count() >= 0 else "no rows")
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:700]}"
        bad += result is not None
        print(f"{'FAIL' if result else 'ok  '} {query_name} {time.time() - begun:.1f}s {result or ''}", flush=True)
    print(f"{bad} failing")
