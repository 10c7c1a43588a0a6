from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from spanforge.operators import payload, relations
from spanforge.sources import markdown, sinks
from spanforge.streaming import inbox
from tests.test_operators import B, D, O, P, spans


def test_issues(spark, tmp_path):
    (tmp_path / "IISerie-055-2025-03-21Supl.md").write_text("A\nb", encoding="utf-8")
    (tmp_path / "notes.md").write_text("x", encoding="utf-8")
    got = {r.doc_id: (r.series, r.number, str(r.issue_date), r.is_suppl, r.text) for r in markdown.issues(spark, str(tmp_path)).collect()}
    assert got == {"IISerie-055-2025-03-21Supl": ("II", 55, "2025-03-21", True, "A\nb"), "notes": (None, None, "None", False, "x")}
    rows = spark.createDataFrame([("IIIserie-1",), ("IISerie-1",)], "n string")
    assert [r.x for r in rows.select(markdown.is_title_driven("n").alias("x")).collect()] == [True, False]


def test_pages_and_missing(spark):
    pages = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (0, 2, "c")], "doc_id long, page_no int, md string")
    assert markdown.join_pages(pages).first().text == "a\n\n---\n\nb"
    assert markdown.missing(pages, pages).count() == 0


def test_issue_texts(spark):
    page = "**CAMARA**\n**DO FUNCHAL**\n**Um aviso**\n**outro**\ntexto\n"
    pages = [("IISerie-1", 0, page), ("IISerie-1", 1, "|**A**|\n**B**"), ("IISerie-1", 2, "last"), ("IIISerie-2", 0, page), ("IIISerie-2", 1, "last"), ("one", 0, "only")]
    rows = spark.createDataFrame(pages, "doc_id string, page_no int, md string")
    got = {r.doc_id: r.text for r in markdown.issue_texts(rows).collect()}
    assert got == {
        "IISerie-1": "**CAMARA\nDO FUNCHAL**\n**Um aviso**\n**outro**\ntexto\n\n\n---\n\n|**A**|\n**B**",
        "IIISerie-2": "**CAMARA\nDO FUNCHAL**\n**Um aviso\noutro**\ntexto",
        "one": "",
    }
    one = {(r.doc_id, r.page_no): r.text for r in markdown.page_texts(rows).collect()}
    assert one["IISerie-1", 0] == "**CAMARA\nDO FUNCHAL\nUm aviso\noutro**\ntexto" and len(one) == 6


def test_files_and_markdown_sink(spark, tmp_path):
    segments = spark.createDataFrame([(0, 3, "**Camara  UM**", 0, 6), (0, 4, "falta", None, None)], "doc_id long, item int, org_text string, start long, stop long")
    texts = spark.createDataFrame([(0, "bloco: resto")], "doc_id long, text string")
    (org,) = sinks.org_files(segments, texts, "serie").collect()
    assert (org.name, org.body) == ("serie_ORG_001_Camara_UM.txt", "DOC_BEGIN\nORG: Camara  UM\nbloco:\nDOC_END\n")
    slices = spark.createDataFrame([(0, 3, "Camara UM", 2, "Aviso n.o 1", "corpo")], "doc_id long, item int, org_text string, nth int, doc_name string, text string")
    (doc,) = sinks.doc_files(slices, "serie").collect()
    assert (doc.name, doc.body) == ("serie_ORG_001_DOC_002_Aviso_n.o_1.txt", "DOC_BEGIN\nORG: Camara UM\nDOC: Aviso n.o 1\ncorpo\nDOC_END\n")
    for _ in range(2):
        sinks.write_markdown(texts, f"{tmp_path}/md")
    assert [tuple(r) for r in sinks.read_markdown(spark, f"{tmp_path}/md").collect()] == [("0.md", "bloco: resto")]


def test_markdown_batches_replace_themselves(spark, tmp_path):
    path = f"{tmp_path}/md"
    table = lambda *rows: spark.createDataFrame(list(rows), "doc_id string, text string")
    sinks.write_markdown(table(("a", "one"), ("b/c", "two")), path, batch="1")
    sinks.write_markdown(table(("b/c", "again"), ("d", "three")), path, batch="2")  # what another batch has stays
    broken = table(("e", "x"), ("f", "y")).withColumn("text", F.when(F.col("doc_id") == "f", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_markdown(broken, path, batch="3")
    want = {"a.md": "one", "b/c.md": "two", "d.md": "three"}
    assert {r.name: r.text for r in sinks.read_markdown(spark, path).collect()} == want
    sinks.write_markdown(table(("e", "x"), ("f", "y")), path, batch="3")  # the lost batch runs again
    sinks.write_markdown(table(("b/c", "again"), ("d", "other")), path, batch="2")
    assert {r.name: r.text for r in sinks.read_markdown(spark, path).collect()} == want | {"d.md": "other", "e.md": "x", "f.md": "y"}
    assert spark.read.parquet(path).count() == 5


def test_results_page(spark):
    segments = spark.createDataFrame([(0, 0, "<A>", "ok"), (0, 1, "B", "org_missing")], "doc_id long, item int, org_text string, status string")
    slices = spark.createDataFrame([(0, 0, 1, "T&t", "corpo <x>"), (0, 0, 2, "U", "fim")], "doc_id long, item int, nth int, doc_name string, text string")
    entities = spark.createDataFrame([(0, 0, 1, "ORG_LABEL", "CAMARA", 3, 9)], "doc_id long, item int, nth int, label string, text string, start long, end long")
    subs = spark.createDataFrame([(0, 0, 1, 1, "Sub", ["h1", "h<2>"], "parte")], "doc_id long, item int, nth int, part int, title string, headers array<string>, text string")
    summary = spark.createDataFrame([(0, 2, 1)], "doc_id long, orgs_total int, org_ok int")
    html = sinks.results_html(segments, "doc_id", slices, entities, subs, summary).first().html
    order = ["orgs_total=2, org_ok=1", "01. &lt;A&gt; <small>[ok]", "01.01 — T&amp;t", "corpo &lt;x&gt;", "<code>ORG_LABEL</code> — CAMARA <small>[3:9]", "01.01.01 — Sub", "<li>h&lt;2&gt;</li>", "<pre>parte</pre>", "01.02 — U", sinks.NO_SUBS, "02. B <small>[org_missing]", sinks.NO_DOCS]
    at = [html.index(x) for x in order]
    assert at == sorted(at)
    whole = sinks.spans_html(spark.createDataFrame([(0, "ORG_LABEL", 2, 5)], "doc_id long, label string, start long, end long"), spark.createDataFrame([(0, "a <b> c"), (1, "none & all")], "doc_id long, text string"))
    got = {r.doc_id: r.html for r in whole.collect()}
    assert 'a <mark style="background:#6e77b8" title="ORG_LABEL">&lt;b&gt;</mark> c</body>' in got[0] and "none &amp; all</body>" in got[1]


def test_nested_page_and_files(spark):
    """Each nested slice is shown once, and has a name of its own."""
    nested = spark.createDataFrame([(0, 3, 0, "CAMARA UM", "ok"), (0, 3, 1, "CAMARA DOIS", "ok"), (0, 4, 0, "OUTRA", "org_missing")], "doc_id long, item int, sub int, sub_text string, status string")
    slices = spark.createDataFrame([(0, 3, 0, "CAMARA UM", 1, "Doc", "texto um"), (0, 3, 1, "CAMARA DOIS", 1, "Doc", "texto dois")], "doc_id long, item int, sub int, sub_text string, nth int, doc_name string, text string")
    entities = spark.createDataFrame([(0, 3, 1, 1, "ORG_LABEL", "AQUI", 0, 4)], "doc_id long, item int, sub int, nth int, label string, text string, start long, end long")
    subs = spark.createDataFrame([(0, 3, 1, 1, 1, "Parte", ["h"], "resto")], "doc_id long, item int, sub int, nth int, part int, title string, headers array<string>, text string")
    html = sinks.results_html(nested, "doc_id", slices, entities, subs).first().html
    assert [html.count(x) for x in ("texto um", "texto dois", "AQUI", "resto", "01.01 — Doc", "02.01 — Doc", "02.01.01 — Parte", "03. OUTRA")] == [1] * 8
    names = [r.name for r in sinks.doc_files(slices, "x").collect()]
    assert sorted(names) == ["x_SUBORG_001_DOC_001_Doc.txt", "x_SUBORG_002_DOC_001_Doc.txt"]


def test_contents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"items": [{"paragraph_id": 0, "org": {"text": "A", "label": "x"}, "docs": []}]}), encoding="utf-8")
    row = markdown.contents(spark, str(tmp_path)).first()
    assert row["items"][0].org.text == "A" and row["items"][0].top_org is None


def test_settings_precedence(tmp_path, monkeypatch):
    (tmp_path / "config").mkdir()
    (tmp_path / "config/settings.json").write_text('{"pdf_markup": {"crop_top": 0.2, "input_dir": ""}}')
    (tmp_path / "config/settings.dev.json").write_text("{broken")
    markdown.settings.cache_clear()
    got = markdown.settings(str(tmp_path))
    assert (got.crop_top, str(got.input_dir)) == (0.2, "input_pdfs")
    markdown.settings.cache_clear()
    monkeypatch.setenv("PDF_MARKUP_CROP_TOP", "x")
    assert markdown.settings(str(tmp_path)).crop_top == 0.10
    markdown.settings.cache_clear()


def test_sinks(spark, tmp_path):
    found = relations.relations_by_title(spans(spark, [O, D, P, B])).cache()
    sinks.write_csv(found, f"{tmp_path}/csv")
    back = spark.read.csv(f"{tmp_path}/csv", header=True)
    assert back.columns == ["doc_id", "paragraph_id", "kind", "head_label", "head_text", "tail_label", "tail_text"] and back.count() == 2
    sinks.write_grouped_json(found, f"{tmp_path}/grouped")
    assert json.loads(spark.read.text(f"{tmp_path}/grouped").first().value)["paragraphs"][0]["relations"][0]["kind"]
    sinks.write_ndjson(found, f"{tmp_path}/nd")
    sinks.write_by_head(found, f"{tmp_path}/head")
    sinks.write_contents(payload.items_by_title(found), f"{tmp_path}/items")
    assert spark.read.json(f"{tmp_path}/items").count() == 1
    docs = spark.createDataFrame([(0, 1, 1, "A", "x/y", "t")], "doc_id long, org_idx int, doc_idx int, org string, doc_name string, text string")
    sinks.write_envelopes(docs, f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").first().body.startswith("DOC_BEGIN\nORG: A")


def test_html(spark):
    rows = spans(spark, [O, B], ["A", "<b>"])
    texts = spark.createDataFrame([(0, "A <b>")], "doc_id long, text string")
    assert "&lt;b&gt;" in sinks.spans_html(rows, texts).first().html
    segments = spark.createDataFrame([(0, 0, "<A>", "ok")], "doc_id long, item int, org_text string, status string")
    assert "&lt;A&gt;" in sinks.results_html(segments).first().html


def test_inbox(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("ORG\nBody text.", encoding="utf-8")
    for _ in range(2):
        inbox.watch(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.label for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [B, O]
