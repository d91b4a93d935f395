"""Run registered queries next to their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "DATE": "date",
}


def compare(spark, con, sf_dir: str, fn, sql: str | None) -> str:
    """'' if equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return ""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = dict(df.dtypes)
    for c, t in zip(rel.columns, rel.types):
        if KINDS.get(str(t), str(t)) != types[c]:
            return f"type of {c}: {types[c]} != {t}"
    want = rel.fetchall()
    if not want:
        return "the SQL gives no rows"
    a, b = _rows(df.columns, got), _rows(rel.columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}; spark {a[:2]} sql {b[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} != {y}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from quadloom.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    prefixes = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, fn, entry.oracle_sql().get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        mark = "ok " if not problem else "BAD"
        print(f"{mark} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print("bad:", bad)
