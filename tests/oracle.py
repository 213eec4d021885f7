"""Compare a registered Spark query with its SQL oracle, value by value."""

from __future__ import annotations

import math
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def type_class(name: str) -> str:
    name = name.lower()
    for known in ("int", "long"):
        if known in name and "array" not in name and "[]" not in name:
            return "whole"
    if "double" in name or "float" in name or "decimal" in name:
        return "real"
    return "text" if name in ("string", "varchar") else name


def compare(spark, name, query, sql, sf_dir, con=None):
    """Differences as text, empty when both results are the same."""
    con = con or connect(sf_dir)
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_s = time.time() - start
    start = time.time()
    rel = con.sql(sql)
    want_columns, want = rel.columns, rel.fetchall()
    duck_s = time.time() - start
    timing = f"{len(got)} rows, spark {spark_s:.1f}s, duckdb {duck_s:.1f}s"
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}", timing
    ours = {c: type_class(t) for c, t in df.dtypes}
    theirs = {c: type_class(str(t)) for c, t in zip(rel.columns, rel.types)}
    if ours != theirs:
        return f"types {ours} != {theirs}", timing
    a, b = rows(df.columns, got), rows(want_columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}", timing
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]}", timing
    return "", timing
