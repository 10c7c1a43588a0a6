"""Comparison of a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "asDict"):
        return tuple(plain(x) for x in value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def compare(spark, query, sql: str) -> None:
    got = query(spark, FOLDER)
    columns = sorted(got.columns)
    want = connection().sql(sql)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in got.collect())
    assert rows == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
