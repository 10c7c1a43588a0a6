from __future__ import annotations

import pytest

from spanforge.plans import catalogue
from tests.oracle import FOLDER, compare


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert {"lang", "label", "n_spans"} <= set(__spark_entry__.entry(spark).columns)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_keys_of_every_line(spark):
    import duckdb

    got = {(r.source, r.id, r.line_no) for r in catalogue.QUERIES["norm_keys"](spark, FOLDER).collect()}
    want = set()
    for name in ("documents", "benchmark"):
        for key, text in duckdb.sql(f"SELECT {'doc_id' if name == 'documents' else 'item_id'}, text FROM '{FOLDER}/{name}.parquet'").fetchall():
            want |= {(name, key, n) for n in range(len(text.split("\n")) if text is not None else 0)}
    assert got == want


def test_zip_keeps_extra_slices(spark):
    got = catalogue.QUERIES["ordinal_zip"](spark, FOLDER)
    assert got.count() == spark.read.parquet(f"{FOLDER}/orders.parquet").count()
    assert got.where("l_orderkey is null").count() > 0 and got.where("l_orderkey is not null").count() > 0
