from __future__ import annotations

import hashlib
import random
import re

import duckdb

from spanforge.llm import fill_middle as fm
from tests.llm.data import awkward, empty, prose, table
from tests.oracle import FOLDER, compare


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


ODD = ["\u0001", "\u0002", "\u00023", "\u00024\u0001", "a\u0001b\u00022", "<", "<<P", "<S", "x<P>y", "<M>", "P>", "3 4", "é漢😀퟿", "\r\n\t ", "$0 \\1", "aB1cD2" * 50]


def rows():
    rng = random.Random(12)
    drawn = ["".join(rng.choice("abZ \n<>PSM\u0001\u000234é😀$\\") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts = [*ODD, *drawn, prose(rng, 20_000)]
    return [(i, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in awkward()]


def test_parts_equal_brute_force(spark):
    given = rows()
    docs = spark.createDataFrame(given, "doc_id long, text string")
    got = fm.transformed(docs).withColumn("back", fm.restored(fm.F.col("output"), fm.F.col("form"))).collect()
    want = [brute(*r) for r in given]
    assert sorted(((r.doc_id, r.n, r.form, r.prefix, r.middle, r.output) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.back) for r in got) == sorted((d is None, d or 0, t or "") for d, t in given)
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_clashing_columns_and_empty_table(spark):
    assert fm.transformed(table(spark)).count() == len(awkward())
    clashing = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n int, marks string")
    assert fm.transformed(clashing).first().n == 3
    assert fm.transformed(empty(spark)).count() == 0


def test_query_equals_its_sql(spark):
    compare(spark, fm.query, fm.ORACLE_SQL)
    plan = fm.query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert duckdb.sql(f"SELECT count(*) FROM '{FOLDER}/documents.parquet'").fetchall()[0][0] == fm.query(spark, FOLDER).count()
