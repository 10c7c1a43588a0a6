from __future__ import annotations

from spanforge.operators import segment
from spanforge.plans import flow

FLAT = """**Sumário**

**CAMARA UM**
**Despacho n.o 1**
Nomeia uma pessoa.
**Despacho n.o 2**
Outra coisa.

**CAMARA  UM**
**Despacho n.o 1**
Texto do primeiro despacho.
**Despacho n.o 2**
Texto do segundo despacho."""

TITLED = """**Sumário**
CAMARA DO TRABALHO
**Regulamentos:**
Primeiro aviso
CAMARA DO TRABALHO
**Regulamentos:**
**Primeiro aviso**
Corpo do aviso."""


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_parts(spark):
    got = {r.doc_id: r for r in flow.parts(docs(spark, FLAT, "no marker", None, "")).collect()}
    assert got[0].reason is None and got[0].body.startswith("**CAMARA  UM**") and got[0].summary.strip().startswith("**CAMARA UM**")
    assert (got[1].reason, got[1].summary, got[1].body) == ("no_sumario", None, "no marker")
    assert 2 not in got


def test_starred_flow(spark):
    out = flow.starred(docs(spark, FLAT.replace("**CAMARA UM**", "CAMARA UM").replace("**CAMARA  UM**", "CAMARA  UM"), "nothing"))
    (row,) = out["segments"].collect()
    assert (row.status, row.n_docs, [s.doc_name for s in row.slices]) == ("ok", 2, ["Despacho n.o 1", "Despacho n.o 2"])
    assert out["nested"].count() == 0
    assert out["summary"].first().org_ok == 1
    starred = flow.starred(docs(spark, FLAT))
    assert starred["segments"].count() == 0 and starred["relations"].count() == 0  # a starred heading without a plain one


def test_titled_flow(spark):
    out = flow.titled(docs(spark, TITLED))
    assert [(r.status, r.confidence) for r in out["segments"].collect()] == [("doc_type_segment", 1.0)]
    assert [r.orgs_in_payload for r in out["summary"].collect()] == [1]
    assert out["subs"].count() == 1


def test_sub_slices(spark):
    text = "lead\n**Um titulo longo**\ncorpo um\n**Ignorado aqui**\ncorpo dois\n**Outro titulo**\nfim"
    segments = spark.createDataFrame([(0, "a", text), (0, "b", "sem titulos")], "doc_id long, segment string, text string")
    allowed = spark.createDataFrame([(0, "a", 0, "Um Titulo Longo"), (0, "a", 1, "Outro titulo:")], "doc_id long, segment string, ord int, title string")
    got = [(r.segment, r.title, text[r.start : r.stop] if r.segment == "a" else (r.start, r.stop)) for r in segment.sub_slices(segments, allowed).orderBy("segment", "sub").collect()]
    assert got == [("a", "Um Titulo Longo", "\ncorpo um\n**Ignorado aqui**\ncorpo dois\n"), ("a", "Outro titulo:", "\nfim"), ("b", "", (0, 11))]
    other = spark.createDataFrame([(0, "a", 0, "Nada disto")], "doc_id long, segment string, ord int, title string")
    lead = segment.sub_slices(segments.where("segment = 'a'"), other).collect()
    assert [(r.title, r.headers, text[r.start : r.stop][:9]) for r in lead] == [("Um titulo longo", ["Um titulo longo"], "\ncorpo um")]


def test_titled_flow_counts_and_entities(spark):
    out = flow.titled(docs(spark, TITLED, "sem nada"))
    rows = {r.doc_id: r for r in out["summary"].collect()}
    assert (rows[0].orgs_in_payload, rows[0].org_windows_found, rows[0].doc_type_headers_matched, rows[0].doc_type_segments, rows[0].segments_with_subdivisions) == (1, 1, 1, 1, 1)
    assert (rows[1].orgs_in_payload, rows[1].org_windows_found, rows[1].doc_type_segments) == (1, 1, 0)
    assert [r.text for r in out["orgs"].where("doc_id = 1").collect()] == [segment.NO_ORG]
    (text,) = [r.text for r in out["texts"].collect()]
    assert "Regulamentos" not in text and "Corpo do aviso." in text
    assert all(text[r.start : r.end] == r.text for r in out["entities"].collect()) and out["entities"].count() > 0


def test_nested_flow(spark):
    body = "**TOPO GERAL**\nCAMARA UM\n**Despacho um**\nTexto.\nCAMARA DOIS\n**Despacho dois**\nTexto dois."
    out = flow.starred(docs(spark, f"**Sumário**\n{body}\n{body}"))
    got = {r.sub_text: (r.status, r.n_docs, r.n_slices) for r in out["nested"].collect()}
    assert got == {"CAMARA UM": ("ok", 1, 1), "CAMARA DOIS": ("ok", 1, 1)}
    assert (out["summary"].first().orgs_total, out["summary"].first().org_ok) == (2, 2)
    made = flow.slice_texts(out["nested"], flow.labelled_parts(docs(spark, f"**Sumário**\n{body}\n{body}")).bodies)
    assert {r.doc_name: r.text.split("\n")[0] for r in made.collect()} == {"Despacho um": "CAMARA UM", "Despacho dois": "CAMARA DOIS"}


def test_mixed_issues_in_one_table(spark):
    flat = FLAT.replace("**CAMARA UM**", "CAMARA UM").replace("**CAMARA  UM**", "CAMARA  UM")
    rows = [("IISerie-001-2003", flat), ("IIISerie-015-2003", TITLED), ("IISerie-002", "nada"), ("IIISerie-002", None), ("notes", flat.replace("UM", "DOIS"))]
    got = flow.results(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.series, r.status) for r in got} == {
        ("IISerie-001-2003", "II", "ok"), ("notes", "II", "ok"), ("IIISerie-015-2003", "III", "doc_type_segment"), ("IISerie-002", "II", "invalid_payload"), ("IIISerie-002", "III", "invalid_payload"),
    }
    docs_ = sorted((r.org, r.doc_no, r.doc_name) for r in got if r.series == "II" and r.status == "ok")
    assert docs_ == [("CAMARA DOIS", 1, "Despacho n.o 1"), ("CAMARA DOIS", 2, "Despacho n.o 2"), ("CAMARA UM", 1, "Despacho n.o 1"), ("CAMARA UM", 2, "Despacho n.o 2")]
    (row,) = [r for r in got if r.status == "doc_type_segment"]
    assert row.confidence == 1.0 and row.entities and "Corpo do aviso." in row.text and len(row.subs) == 1


def test_losses(spark):
    body = "**TOPO GERAL**\n**Sem dono**\nCAMARA UM\n**Despacho um**\nTexto.\nCAMARA DOIS\n**Despacho dois**\nTexto dois."
    out = flow.starred(docs(spark, f"**Sumário**\n{body}\n**TOPO GERAL**\nCAMARA UM\n**Despacho um**\nTexto."))
    got = {(r.reason, r.name) for r in out["losses"].collect()}
    assert got == {("before_org", "**Sem dono**"), ("org_missing", "**Despacho dois**")}
    counts = out["summary"].first()
    assert (counts.org_ok, counts.org_ok_ref, counts.docs_expected, counts.docs_matched, counts.org_missing) == (1, 0, 2, 1, 1)
