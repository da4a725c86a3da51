"""Compare a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normal_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return normal_rows(columns, cur.fetchall())


_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int",
    "hugeint": "huge", "double": "float", "float": "float", "varchar": "string", "string": "string",
    "boolean": "boolean", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def spark_types(df):
    return {c: _FAMILY.get(t, t) for c, t in df.dtypes}


def duck_types(con, sql):
    rows = con.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: _FAMILY.get(str(r[1]).lower(), str(r[1]).lower()) for r in rows}
