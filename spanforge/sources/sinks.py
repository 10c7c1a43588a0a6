"""Sinks: relations and results as NDJSON, JSON, CSV, text files and HTML, all written by the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions.text import html_escape, plain_text, slug, strip_bold
from spanforge.operators import payload

#: Colours of labels.
COLOURS = {
    "Sumario": "#ffd166",
    "ORG_LABEL": "#6e77b8",
    "ORG_WITH_STAR_LABEL": "#6fffff",
    "DOC_NAME_LABEL": "#b23bbd",
    "DOC_TEXT": "#47965e",
    "PARAGRAPH": "#14b840",
    "JUNK_LABEL": "#e11111",
    "SERIE_III": "#D1B1B1",
}


def write_ndjson(relations: DataFrame, path: str) -> None:
    relations.write.json(path)


def write_csv(relations: DataFrame, path: str, key: str = "doc_id") -> None:
    payload.compact(relations, key).drop("ord").write.csv(path, header=True)


def write_grouped_json(relations: DataFrame, path: str, key: str = "doc_id", full: bool = False) -> None:
    payload.grouped_json(relations, key, full).select("json").write.text(path)


def write_by_head(relations: DataFrame, path: str, key: str = "doc_id") -> None:
    payload.by_head(relations, key).write.json(path)


def write_contents(items: DataFrame, path: str, key: str = "doc_id") -> None:
    """One JSON object for each document, its items in order."""
    order = F.struct(F.col("paragraph_id").alias("_o"), F.struct(*(c for c in items.columns if c != key)).alias("item"))
    items.groupBy(key).agg(F.array_sort(F.collect_list(order))["item"].alias("items")).write.json(path)


def envelope(org: Column, name: Column, text: Column) -> Column:
    return F.concat_ws("\n", F.lit("DOC_BEGIN"), F.concat(F.lit("ORG: "), org), F.concat(F.lit("DOC: "), name), text, F.lit("DOC_END"))


#: Folders that envelopes are dealt into, however many documents there are.
FOLDERS = 64


def write_envelopes(docs: DataFrame, path: str, key: str = "doc_id") -> None:
    """docs (key, org_idx, doc_idx, org, doc_name, text) as rows of name and body; the whole key is a column beside the name, so none overwrites another."""
    name = F.concat_ws("_", F.format_string("ORG_%03d_DOC_%03d", "org_idx", "doc_idx"), slug("doc_name"))
    rows = docs.select(F.col(key).alias("document"), name.alias("name"), envelope(F.col("org"), F.col("doc_name"), F.col("text")).alias("body"))
    rows.withColumn("folder", F.pmod(F.xxhash64("document"), F.lit(FOLDERS))).write.partitionBy("folder").json(path)


def org_files(segments: DataFrame, texts: DataFrame, prefix: str, key: str = "doc_id") -> DataFrame:
    """key, name, body of a text file for each organisation found: segments (key, item, org_text, start, stop), texts (key, text)."""
    nth = F.row_number().over(W.partitionBy(key).orderBy("item"))
    block = F.substring("_text", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    rows = segments.withColumn("nth", nth).where("start is not null").join(texts.select(key, F.col("text").alias("_text")), key)
    name = F.concat(F.lit(f"{prefix}_ORG_"), F.lpad(F.col("nth").cast("string"), 3, "0"), F.lit("_"), slug(plain_text("org_text")), F.lit(".txt"))
    body = F.concat(F.lit("DOC_BEGIN\nORG: "), strip_bold("org_text"), F.lit("\n"), block, F.lit("\nDOC_END\n"))
    return rows.select(key, name.alias("name"), body.alias("body"))


def _org_of(rows: DataFrame) -> tuple[list[str], Column]:
    """What tells an organisation apart in flat or nested segments and slices, and its name."""
    nested = "sub" in rows.columns
    return (["item", "sub"] if nested else ["item"]), F.col("sub_text" if nested and "sub_text" in rows.columns else "org_text")


def doc_files(slices: DataFrame, prefix: str, key: str = "doc_id") -> DataFrame:
    """key, name, body of a text file for each slice of an organisation: slices (key, item, org_text or sub and sub_text, nth, doc_name, text), flat or nested; no two of a key have one name."""
    by, org = _org_of(slices)
    number = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    rows = slices.withColumn("_org", F.dense_rank().over(W.partitionBy(key).orderBy(*by)))
    name = F.concat(F.lit(f"{prefix}_{'SUBORG' if len(by) > 1 else 'ORG'}_"), number("_org"), F.lit("_DOC_"), number("nth"), F.lit("_"), slug(plain_text("doc_name")), F.lit(".txt"))
    body = F.concat(F.lit("DOC_BEGIN\nORG: "), strip_bold(org), F.lit("\nDOC: "), F.col("doc_name"), F.lit("\n"), F.col("text"), F.lit("\nDOC_END\n"))
    return rows.select(key, name.alias("name"), body.alias("body"))


#: Partitions of the Markdown sink by a hash of the name.
BUCKETS = 256
MARKDOWN = "name string, text string, bucket int, batch string"


def write_markdown(docs: DataFrame, path: str, key: str = "doc_id", batch: str = "0") -> None:
    """Add the texts of docs (key, text) that no other batch has written to path, as rows of name and text in partitions by bucket and batch.

    A batch that runs again, after it was lost or with other texts, replaces its
    own partitions and nothing else.  Names written before are looked up in the
    buckets of the batch only.  Batches may run side by side; if two write one
    name, read_markdown() takes that of the lesser batch.
    """
    spark = docs.sparkSession
    rows = docs.select(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(".md")).alias("name"), "text")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(BUCKETS)).cast("int")).withColumn("batch", F.lit(batch))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        wanted = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most BUCKETS
        there = spark.read.schema(MARKDOWN).parquet(path).where(F.col("bucket").isin(wanted) & (F.col("batch") != batch))
        rows = rows.join(there.select("bucket", "name"), ["bucket", "name"], "left_anti")
    rows.select("name", "text", "bucket", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """name, text of what write_markdown() has written."""
    rows = spark.read.schema(MARKDOWN).parquet(path)
    return rows.groupBy("bucket", "name").agg(F.min_by("text", "batch").alias("text")).select("name", "text")


def spans_html(spans: DataFrame, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, html: each document's whole text, its spans in colour with their labels."""
    colour = F.lit("#dddddd")
    for label, value in COLOURS.items():
        colour = F.when(F.col("label") == label, value).otherwise(colour)
    part = lambda a, b: html_escape(F.substring("text", (a + 1).cast("int"), (b - a).cast("int")))
    mark = F.concat(F.lit('<mark style="background:'), colour, F.lit('" title="'), F.col("label"), F.lit('">'), part(F.col("start"), F.col("end")), F.lit("</mark>"))
    before = F.coalesce(F.lag("end").over(W.partitionBy(key).orderBy("start")), F.lit(0))
    placed = spans.select(key, "label", "start", "end", before.alias("before")).join(texts.select(key, "text"), key)
    marks = placed.select(key, "start", "end", F.concat(part(F.col("before"), F.col("start")), mark).alias("mark"))
    joined = marks.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "mark")))["mark"], "").alias("marks"), F.max("end").alias("last"))
    rows = texts.select(key, F.coalesce("text", F.lit("")).alias("text")).join(joined, key, "left")
    rest = part(F.coalesce("last", F.lit(0)), F.length("text"))
    return rows.select(key, F.concat(F.lit(PAGE.format(title="Entidades")), F.coalesce("marks", F.lit("")), rest, F.lit("</body>")).alias("html"))


#: What the pages say.
PAGE = '<!doctype html><meta charset="utf-8"><title>{title}</title><body style="white-space:pre-wrap">'
NO_DOCS, WHOLE, ENTITIES = "Sem documentos neste bloco.", "Segmento completo", "Entidades no segmento (segunda passagem)"
SUBS, HEADERS, NO_SUBS = "Subdivisões", "Headers colapsados:", "Sem subdivisões para este segmento."


def _listed(rows: DataFrame, by: list[str], order: str, html: Column, name: str) -> DataFrame:
    return rows.select(*by, F.struct(F.col(order).alias("o"), html.alias("h")).alias("_x")).groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("_x"))["h"], "").alias(name))


def results_html(segments: DataFrame, key: str = "doc_id", slices: DataFrame | None = None, entities: DataFrame | None = None, subs: DataFrame | None = None, summary: DataFrame | None = None) -> DataFrame:
    """key, html: the counters, organisations with their status, their documents, and of each its entities and sub-slices, in order, every value escaped.

    segments (key, item, org_text, status) and slices (key, item, nth, doc_name,
    text), or nested ones with sub and sub_text; entities (the slices' key, item,
    sub and nth; label, text, start, end); subs (the same; part, title, headers,
    text); summary (key and counters).
    """
    e = lambda c: html_escape(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    own, name = _org_of(segments)
    orgs = segments.select(key, *own, name.alias("org_text"), "status", F.row_number().over(W.partitionBy(key).orderBy(*own)).alias("i"))
    rows = orgs.withColumn("docs", F.lit(None).cast("string"))
    if slices is not None:
        by = [key, *own, "nth"]
        one = slices.select(*by, "doc_name", "text").join(orgs.select(key, *own, "i"), [key, *own])
        if entities is not None:
            entry = F.concat(F.lit("<li><code>"), e("label"), F.lit("</code> — "), e("text"), F.lit(" <small>["), F.col("start").cast("string"), F.lit(":"), F.col("end").cast("string"), F.lit("]</small></li>"))
            one = one.join(_listed(entities, by, "start", entry, "ents"), by, "left")
        if subs is not None:
            heads = F.array_join(F.transform("headers", lambda h: F.concat(F.lit("<li>"), html_escape(h), F.lit("</li>"))), "")
            named = subs.join(orgs.select(key, *own, "i"), [key, *own])
            entry = F.concat(
                F.lit("<h5>"), two("i"), F.lit("."), two("nth"), F.lit("."), two("part"), F.lit(" — "), e("title"), F.lit("</h5>"),
                F.when(F.size("headers") > 0, F.concat(F.lit(f"<p><strong>{HEADERS}</strong></p><ul>"), heads, F.lit("</ul>"))).otherwise(""),
                F.lit("<pre>"), e("text"), F.lit("</pre>"),
            )
            one = one.join(_listed(named, by, "part", entry, "parts"), by, "left")
        shown = [F.lit("<h3>"), two("i"), F.lit("."), two("nth"), F.lit(" — "), e("doc_name"), F.lit(f"</h3><details open><summary>{WHOLE}</summary><pre>"), e("text"), F.lit("</pre></details>")]
        if entities is not None:
            shown.append(F.coalesce(F.concat(F.lit(f"<details><summary>{ENTITIES}</summary><ul>"), F.col("ents"), F.lit("</ul></details>")), F.lit("")))
        parts = F.concat(F.lit(f"<h4>{SUBS}</h4>"), F.col("parts")) if subs is not None else F.lit(None).cast("string")
        shown.append(F.coalesce(parts, F.lit(f"<p><em>{NO_SUBS}</em></p>")))
        rows = orgs.join(_listed(one, [key, *own], "nth", F.concat(*shown), "docs"), [key, *own], "left")
    body = F.concat(F.lit("<h2>"), two("i"), F.lit(". "), e("org_text"), F.lit(" <small>["), e("status"), F.lit("]</small></h2>"), F.coalesce("docs", F.lit(f"<p><em>{NO_DOCS}</em></p>")))
    out = _listed(rows, [key], "i", body, "body")
    head = F.lit("")
    if summary is not None:
        out = out.join(summary.select(key, F.concat(F.lit("<p><strong>Resumo:</strong> "), html_escape(summary_line(summary.drop(key))), F.lit("</p>")).alias("head")), key, "left")
        head = F.coalesce("head", F.lit(""))
    return out.select(key, F.concat(F.lit(PAGE.format(title="Results") + "<h1>Resultados</h1>"), head, "body", F.lit("</body>")).alias("html"))


def summary_line(counters: DataFrame) -> Column:
    """One line of name=value pairs."""
    return F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in counters.columns))
