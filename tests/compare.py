"""Spark-vs-DuckDB comparison of the registered queries (row count, column
names, order-insensitive hash of the values)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def spark_kind(dtype) -> str:
    from pyspark.sql import types as T
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "float"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, T.DecimalType):
        return "decimal"
    if isinstance(dtype, T.StringType):
        return "str"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    return dtype.simpleString()


def duck_kind(type_code) -> str:
    t = str(type_code).upper()
    if t in ("DOUBLE", "FLOAT", "REAL"):
        return "float"
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT", "NUMBER") or t.startswith("INT"):
        return "int"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t in ("VARCHAR", "STRING"):
        return "str"
    if t == "DATE":
        return "date"
    if t == "BOOLEAN":
        return "bool"
    return t.lower()


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = table_digest(df.columns, s_rows)
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    d = table_digest(d_cols, d_rows)
    s_types = {f.name: spark_kind(f.dataType) for f in df.schema.fields}
    d_types = {c[0]: duck_kind(c[1]) for c in res.description}
    type_diff = {k: (s_types[k], d_types.get(k)) for k in s_types if s_types[k] != d_types.get(k)}
    out = {"query": name, "rows_spark": s[0], "rows_oracle": d[0], "columns_match": s[1] == d[1],
           "hash_match": s[2] == d[2], "types_match": not type_diff}
    if type_diff:
        out["type_diff"] = type_diff
    if not out["hash_match"]:
        out["spark_only_cols"] = sorted(set(s[1]) - set(d[1]))
        out["oracle_only_cols"] = sorted(set(d[1]) - set(s[1]))
        if s[1] == d[1]:
            order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
            order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
            ls = sorted("|".join(_norm(r[i]) for i in order_s) for r in s_rows)
            ld = sorted("|".join(_norm(r[i]) for i in order_d) for r in d_rows)
            only_s = sorted(set(ls) - set(ld))[:2]
            only_d = sorted(set(ld) - set(ls))[:2]
            out["example_spark"] = only_s
            out["example_oracle"] = only_d
            out["header"] = "|".join(s[1])
    return out
