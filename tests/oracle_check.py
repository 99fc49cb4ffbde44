"""Compare registered Spark queries with their SQL oracles (DuckDB).

Rows are compared as multisets after sorting columns by name, the same
way the driver's correctness gate does; values must be equal exactly, and
each column's type must map to the oracle's.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_SQL = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    sql_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    type_diff = {c: (t, sql_types.get(c)) for c, t in sdf.dtypes if SPARK_TO_SQL.get(t) != sql_types.get(c)}
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if type_diff:
        problems.append(f"types differ: {type_diff}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} sql={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} sql={len(d_rows)}")
    if not problems:
        a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
