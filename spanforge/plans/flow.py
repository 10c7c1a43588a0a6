"""The whole flow from documents to segments, for both kinds of issue.

    label -> split -> label the parts again -> relations -> contents -> segments

Everything is per document, so all documents of a table run at once; parts are
labelled in one go, with offsets from 0 in each part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.text import strip_bold
from spanforge.operators import payload, relations, segment
from spanforge.operators.labels import numbered
from spanforge.sources.markdown import is_title_driven
from spanforge.sources.staging import staged


def parts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, reason, summary, body: the texts before and after the repeated heading.

    Without a marker there is no summary and the body is the whole text.
    """
    spans = staged(numbered(docs, key), "spans")
    ends = docs.where(F.col("text").isNotNull()).select(key, F.length("text").cast("bigint").alias("n_chars"))
    cut = segment.split_at_repeat(spans, ends, key).join(docs.select(key, "text"), key)
    piece = lambda a, b: F.substring("text", (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int"))
    return cut.select(key, "reason", piece("summary_start", "summary_end").alias("summary"), piece("body_start", "body_end").alias("body"))


@dataclass
class Contents:
    summary_spans: DataFrame
    body_spans: DataFrame
    bodies: DataFrame


def labelled_parts(docs: DataFrame, key: str = "doc_id") -> Contents:
    split = staged(parts(docs, key), "parts")
    both = split.select(key, F.explode(F.array(F.struct(F.lit("summary").alias("part"), F.col("summary").alias("text")), F.struct(F.lit("body").alias("part"), F.col("body").alias("text")))).alias("p")).select(key, "p.*")
    texts = both.where("text is not null and text <> ''").withColumn("_id", F.concat_ws("/", "part", F.col(key).cast("string")))
    found = numbered(texts.select("_id", "text"), "_id").join(texts.select("_id", key, "part"), "_id").drop("_id")
    found = staged(found, "part-spans")
    return Contents(found.where("part = 'summary'").drop("part"), found.where("part = 'body'").drop("part"), split.select(key, F.coalesce("body", F.lit("")).alias("text")))


def starred(docs: DataFrame, key: str = "doc_id") -> dict[str, DataFrame]:
    """relations, items, flat segments, nested segments and counters; a document with a starred item is nested, its flat items are left out."""
    made = labelled_parts(docs, key)
    found = staged(relations.relations_by_star(made.summary_spans, key), "relations")
    items = staged(payload.items_by_star(found, key), "items")
    nested = items.where("top_org is not null")
    flat = items.where("org is not null").join(nested.select(key).distinct(), key, "left_anti").select(key, F.col("paragraph_id").alias("item"), F.col("org.text").alias("org_text"), F.col("docs.text").alias("docs"))
    subs = nested.select(key, F.col("paragraph_id").alias("item"), F.col("top_org.text").alias("top_text"), F.posexplode("sub_orgs").alias("sub", "s")).select(key, "item", "top_text", "sub", F.col("s.org.text").alias("sub_text"), F.col("s.docs.text").alias("docs"))
    segments = staged(segment.segment_flat(made.body_spans, made.bodies, flat, key), "segments")
    inner = staged(segment.segment_nested(made.body_spans, made.bodies, subs, key), "nested")
    counted = [key, "status", "n_docs", "n_missed", "n_slices", "top_found"]
    both = segments.withColumn("top_found", F.lit(None).cast("boolean")).select(*counted).unionByName(inner.select(*counted))
    return {"relations": found, "items": items, "segments": segments, "nested": inner, "bodies": made.bodies, "summary": segment.summary(both, key), "losses": segment.losses_starred(made.summary_spans, items, inner, key)}


def slice_texts(rows: DataFrame, bodies: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row for each slice of flat or nested segments: their columns, nth (from 1), doc_name, and the slice's text."""
    cut = rows.select("*", F.posexplode("slices").alias("_n", "_s")).drop("slices").join(bodies.select(key, F.col("text").alias("_text")), key)
    shown = F.substring("_text", (F.col("_s.start") + 1).cast("int"), (F.col("_s.stop") - F.col("_s.start")).cast("int"))
    return cut.withColumn("nth", F.col("_n") + 1).withColumn("doc_name", F.col("_s.doc_name")).withColumn("text", shown).drop("_n", "_s", "_text")


def titled(docs: DataFrame, key: str = "doc_id") -> dict[str, DataFrame]:
    """relations, organisations, items, segments, their entities, sub-slices and counters of title-driven documents.

    Segments are labelled again from offset 0; a blank one has no entities and
    no sub-slices.  A document without organisations has one made-up one.
    """
    made = labelled_parts(docs, key)
    found = staged(relations.relations_by_title(made.summary_spans, key), "relations")
    items = staged(payload.items_by_title(found, key), "items")
    orgs = staged(segment.org_map(payload.title_orgs(found, key), made.bodies, key), "orgs")
    named = items.select(key, F.col("paragraph_id").alias("item"), "org_ids", F.col("doc_name.text").alias("title"))
    ends = made.bodies.select(key, F.length("text").cast("bigint").alias("n_chars"))
    windows = staged(segment.kept_windows(made.body_spans, orgs, ends, key), "windows")
    located = staged(segment.located_titles(made.body_spans, windows, ends, named, key), "located")
    segments = staged(segment.segment_titles(made.body_spans, made.bodies, orgs, named, key, located, windows), "segments")
    shown = F.substring("_text", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    texts = segments.where("start is not null").join(made.bodies.select(key, F.col("text").alias("_text")), key).select(key, F.concat_ws(".", "org_id", "item").alias("segment"), "item", shown.alias("text"))
    texts = staged(texts.where(F.trim("text") != ""), "segment-texts")
    allowed = payload.allowed_children(items.withColumnRenamed("paragraph_id", "item"), key)
    subs = staged(segment.sub_slices(texts.drop("item"), texts.select(key, "segment", "item").join(allowed, [key, "item"]).drop("item"), key), "subs")
    return {
        "relations": found,
        "bodies": made.bodies,
        "orgs": orgs,
        "items": items,
        "segments": segments,
        "texts": texts,
        "entities": segment_entities(texts, key),
        "subs": subs,
        "summary": segment.summary_titles(segments, orgs, windows, subs, located, key),
        "losses": segment.losses_titled(named, located, key),
    }


def segment_entities(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, segment, seq, label, text, start, end of what stands in each of texts (key, segment, text), with offsets from 0."""
    rows = texts.select(F.concat_ws("/", F.col(key).cast("string"), "segment").alias("_id"), key, "segment", "text")
    return numbered(rows.select("_id", "text"), "_id").join(rows.select("_id", key, "segment"), "_id").select(key, "segment", "seq", "label", "text", "start", "end")


RESULT = "org_no int, org string, org_status string, doc_no int, doc_name string, status string, confidence double, text string, entities array<struct<label:string,text:string,start:bigint,end:bigint>>, subs array<struct<title:string,headers:array<string>,text:string,start:bigint,end:bigint>>"


def results(docs: DataFrame, key: str = "doc_id", name: str = "doc_id") -> DataFrame:
    """Both kinds of issues in one table: key, series, and the columns of RESULT, a row for each document found or missing, or for an organisation without any.

    A name tells the kind of an issue.  An issue whose contents name nothing (or
    that has no text) is one row of the status invalid_payload.
    """
    by_title = F.coalesce(is_title_driven(name), F.lit(False))
    parts = []
    for series, rows, flow_ in (("II", docs.where(~by_title), starred), ("III", docs.where(by_title), titled)):
        rows = rows.select(key, "text")
        made = _shown_starred(flow_(rows, key), key) if series == "II" else _shown_titled(flow_(rows, key), key)
        made = staged(made, "results")
        none = rows.select(key).distinct().join(made.select(key).distinct(), key, "left_anti").withColumn("status", F.lit("invalid_payload"))
        parts.append(made.unionByName(none, allowMissingColumns=True).withColumn("series", F.lit(series)))
    out = parts[0].unionByName(parts[1])
    return out.select(key, "series", *(F.col(c.split()[0]).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in _columns(RESULT)))


def _columns(schema: str) -> list[str]:
    """The columns of a schema text; those within brackets belong to the one before."""
    out, depth = [""], 0
    for char in schema:
        depth += (char == "<") - (char == ">")
        if char == "," and not depth:
            out.append("")
        else:
            out[-1] += char
    return [c.strip() for c in out]


def _shown_starred(made: dict[str, DataFrame], key: str) -> DataFrame:
    """Slices of flat and nested segments, and organisations without one, in the columns of RESULT that they have."""
    parts = []
    for rows, by, org in ((made["segments"], ["item"], "org_text"), (made["nested"], ["item", "sub"], "sub_text")):
        numbered_ = rows.withColumn("org_no", F.row_number().over(W.partitionBy(key).orderBy(*by))).withColumn("org", strip_bold(org)).withColumn("org_status", F.col("status"))
        cut = slice_texts(numbered_, made["bodies"], key).select(key, "org_no", "org", "org_status", F.col("nth").alias("doc_no"), "doc_name", "status", "text")
        empty = numbered_.where("n_slices = 0").select(key, "org_no", "org", "org_status", F.lit(None).cast("int").alias("doc_no"), F.lit(None).cast("string").alias("doc_name"), "status", F.lit("").alias("text"))
        parts.append(cut.unionByName(empty))
    return parts[0].unionByName(parts[1]).withColumn("confidence", F.lit(None).cast("double")).withColumn("entities", F.lit(None).cast("array<struct<label:string,text:string,start:bigint,end:bigint>>")).withColumn("subs", F.lit(None).cast("array<struct<title:string,headers:array<string>,text:string,start:bigint,end:bigint>>"))


def _shown_titled(made: dict[str, DataFrame], key: str) -> DataFrame:
    """Segments with their entities and sub-slices in the columns of RESULT."""
    named = made["segments"].select("*", F.concat_ws(".", "org_id", "item").alias("segment"))
    texts = made["texts"].select(key, "segment", "text")
    entities = made["entities"].groupBy(key, "segment").agg(F.array_sort(F.collect_list(F.struct("seq", F.struct("label", "text", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")).alias("v"))))["v"].alias("entities"))
    shown = F.substring("text", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    cut = made["subs"].join(texts, [key, "segment"]).select(key, "segment", "sub", F.struct("title", "headers", shown.alias("text"), F.col("start").cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("end")).alias("v"))
    subs = cut.groupBy(key, "segment").agg(F.array_sort(F.collect_list(F.struct("sub", "v")))["v"].alias("subs"))
    rows = named.join(texts, [key, "segment"], "left").join(entities, [key, "segment"], "left").join(subs, [key, "segment"], "left")
    orgs = made["orgs"].select(key, F.col("id").alias("org_id"), F.col("text").alias("org"))
    whole = orgs.join(rows, [key, "org_id"], "left")
    doc_no = F.when(F.col("item").isNotNull(), F.row_number().over(W.partitionBy(key, "org_id").orderBy("item")))
    # An issue of one made-up organisation and no item has no contents.
    return whole.where((F.col("org_id") != segment.NO_ORG_ID) | F.col("item").isNotNull()).select(
        key, F.col("org_id").alias("org_no"), "org", F.lit(None).cast("string").alias("org_status"), doc_no.alias("doc_no"), F.col("title").alias("doc_name"), "status", "confidence", F.coalesce("text", F.lit("")).alias("text"), "entities", "subs"
    )
