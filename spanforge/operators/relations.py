"""Ordered relations between labelled spans: paragraphs, heads and tails.

Spans are rows (key, seq, label, text, start, end), seq giving the order within
a key.  Nothing here joins a table with itself: heads and tails are found by
windows over a paragraph, and rows that stand for several relations are exploded
from a small array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V

LABELS = [V.ORG, V.ORG_STAR, V.TITLE, V.BODY, V.PARAGRAPH]
BODIES = [V.BODY, V.PARAGRAPH]
ORGS = [V.ORG, V.ORG_STAR]


def span(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + c).alias(c) for c in ("seq", "label", "text", "start", "end")))


def paragraphs_by_star(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """paragraph_id: a starred heading opens one; a plain heading does while no star has been seen; null before the first."""
    w = W.partitionBy(key).orderBy("seq")
    star = F.col("label") == V.ORG_STAR
    seen = F.max(star.cast("int")).over(w)
    opens = star | ((F.col("label") == V.ORG) & (seen == 0))
    number = F.sum(opens.cast("int")).over(w) - 1
    return spans.where(F.col("label").isin(LABELS)).withColumn("paragraph_id", F.when(number >= 0, number).cast("int"))


def paragraphs_by_title(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """paragraph_id: every title opens one, the first heading does if nothing has; a title brings copies of the heading it is under and of a marker seen since that heading.

    part orders the copies (heading 0, marker 1) before the span itself (2).
    Markers stand only as copies.
    """
    w = W.partitionBy(key).orderBy("seq")
    up_to = w.rowsBetween(W.unboundedPreceding, 0)
    is_org, is_title = F.col("label").isin(ORGS), F.col("label") == V.TITLE
    rows = spans.where(F.col("label").isin([*LABELS, V.MARKER]))
    state = rows.select(
        "*",
        F.sum(is_title.cast("int")).over(up_to).alias("n_titles"),
        F.min(F.when(is_org, F.col("seq"))).over(up_to).alias("first_org"),
        F.min(F.when(is_title, F.col("seq"))).over(W.partitionBy(key)).alias("first_title"),
        F.last(F.when(is_org, span()), ignorenulls=True).over(up_to).alias("under"),
        F.last(F.when(F.col("label") == V.MARKER, span()), ignorenulls=True).over(up_to).alias("marker"),
    )
    org_first = F.col("first_org").isNotNull() & (F.col("first_title").isNull() | (F.col("first_org") < F.col("first_title")))
    number = F.col("n_titles") + org_first.cast("int") - 1
    holds = F.col("marker").isNotNull() & F.col("under").isNotNull() & (F.col("marker.seq") > F.col("under.seq"))
    copies = F.array(
        F.when(is_title & F.col("under").isNotNull(), F.struct(F.lit(0).alias("part"), F.col("under").alias("s"))),
        F.when(is_title & holds, F.struct(F.lit(1).alias("part"), F.col("marker").alias("s"))),
        F.when(F.col("label") != V.MARKER, F.struct(F.lit(2).alias("part"), span().alias("s"))),
    )
    placed = state.select(key, F.col("seq").alias("at"), F.when(number >= 0, number).cast("int").alias("paragraph_id"), F.explode(F.array_compact(copies)).alias("c"))
    return placed.select(key, "paragraph_id", "at", F.col("c.part").alias("part"), F.col("c.s.*"))


def _relation(kind: Column | str, head: Column, tail: Column, phase: int) -> Column:
    return F.struct(F.lit(phase).alias("phase"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), head.alias("head"), tail.alias("tail"))


def _numbered(found: DataFrame, key: str) -> DataFrame:
    """Relations in the order in which a left-to-right scan would give them."""
    order = W.partitionBy(key).orderBy(F.col("paragraph_id").asc_nulls_first(), "phase", "head.seq", "tail.seq")
    return found.withColumn("ord", F.row_number().over(order)).select(key, "ord", "paragraph_id", "kind", "head", "tail")


def relations_by_star(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Relations where headings open paragraphs: key, ord, paragraph_id, kind, head, tail.

    A starred heading is linked to every plain heading of its paragraph, and only
    what stands under one of those is linked further; a heading to all its
    titles; a title to the first text line and the first paragraph after it.
    """
    up_to = W.partitionBy(key).orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    back = W.partitionBy(key).orderBy(F.desc("seq")).rowsBetween(W.unboundedPreceding, 0)
    last = lambda when, over: F.last(F.when(when, span()), ignorenulls=True).over(over)
    is_org, star = F.col("label") == V.ORG, F.col("label") == V.ORG_STAR
    # Every heading opens a paragraph or a block, so the next text before any heading is that of the block.
    rows = paragraphs_by_star(spans, key).withColumn("opens", star | (is_org & (F.max(star.cast("int")).over(up_to) == 0)))
    rows = rows.withColumn("first", last(F.col("opens"), up_to)).withColumn("org", last(is_org, up_to))
    rows = rows.withColumn("body", last(is_org | star | (F.col("label") == V.BODY), back)).withColumn("para", last(is_org | star | (F.col("label") == V.PARAGRAPH), back))
    of_kind = lambda c, label: F.when(F.col(f"{c}.label") == label, F.col(c))
    org = F.when(F.col("org.seq") >= F.col("first.seq"), F.col("org"))
    rows = rows.withColumn("org", org).withColumn("body", of_kind("body", V.BODY)).withColumn("para", of_kind("para", V.PARAGRAPH))
    in_star = F.coalesce(F.col("first.label") == V.ORG_STAR, F.lit(False))
    linked = ~in_star | F.col("org").isNotNull()
    title = linked & (F.col("label") == V.TITLE)
    found = F.array(
        F.when(in_star & (F.col("label") == V.ORG), _relation(V.STAR_ORG, F.col("first"), span(), 0)),
        F.when(title & F.col("org").isNotNull(), _relation(V.ORG_TITLE, F.col("org"), span(), 1)),
        F.when(title & F.col("body").isNotNull(), _relation(V.TITLE_BODY, span(), F.col("body"), 1)),
        F.when(title & F.col("para").isNotNull(), _relation(V.TITLE_BODY, span(), F.col("para"), 1)),
    )
    return _numbered(rows.select(key, "paragraph_id", F.inline(F.array_compact(found))), key)


def relations_by_title(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Relations where titles open paragraphs.

    With a marker (mode B) a title is linked to all bodies after it, without one
    (mode A) to the first; a paragraph without a title links its first heading
    to every body.

    The paragraphs are those of paragraphs_by_title(), but nothing is copied: a
    span gives one relation at most, in order, so all is looked up in one order
    of a key's spans.
    """
    up_to = W.partitionBy(key).orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    earlier = up_to.rowsBetween(W.unboundedPreceding, -1)
    is_org, is_title, is_body = F.col("label").isin(ORGS), F.col("label") == V.TITLE, F.col("label").isin(BODIES)
    last = lambda when, value, frame=up_to: F.last(F.when(when, value), ignorenulls=True).over(frame)
    rows = spans.where(F.col("label").isin([*LABELS, V.MARKER])).select(
        key,
        *("seq", "label", "text", "start", "end"),
        F.sum(is_title.cast("int")).over(up_to).alias("n_titles"),
        F.min(F.when(is_title, F.col("seq"))).over(up_to).alias("first_title"),
        F.first(F.when(is_org, span()), ignorenulls=True).over(up_to).alias("first_org"),
        last(is_org, span()).alias("under"),
        last(F.col("label") == V.MARKER, F.col("seq")).alias("marker"),
        last(is_title, span()).alias("title"),
        last(is_title | is_body, is_title, earlier).alias("next_to_title"),
    )
    rows = rows.withColumn("mode_b", last(is_title, F.coalesce(F.col("marker") > F.col("under.seq"), F.lit(False))))
    org_first = F.col("first_org").isNotNull() & (F.col("first_title").isNull() | (F.col("first_org.seq") < F.col("first_title")))
    number = F.col("n_titles") + org_first.cast("int") - 1
    body_kind = F.when(F.col("label") == V.BODY, V.TITLE_BODY).otherwise(V.TITLE_PARAGRAPH)
    org_kind = F.when(F.col("label") == V.BODY, V.ORG_BODY).otherwise(V.ORG_PARAGRAPH)
    title_kind = F.when(F.col("under.label") == V.ORG, V.ORG_TITLE).otherwise(V.STAR_TITLE)
    under_org = is_title & F.col("under").isNotNull()
    under_title = is_body & F.col("title").isNotNull() & (F.col("mode_b") | F.col("next_to_title"))
    untitled = is_body & (F.col("n_titles") == 0) & F.col("first_org").isNotNull()
    kind = F.when(under_org, title_kind).when(under_title, body_kind).when(untitled, org_kind)
    head = F.when(under_org, F.col("under")).when(under_title, F.col("title")).otherwise(F.col("first_org"))
    found = rows.select(key, F.when(number >= 0, number).cast("int").alias("paragraph_id"), "seq", kind.alias("kind"), head.alias("head"), span().alias("tail")).where("kind is not null")
    return found.select(key, F.row_number().over(W.partitionBy(key).orderBy("seq")).alias("ord"), "paragraph_id", "kind", "head", "tail")


def with_evidence(relations: DataFrame, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """relations with evidence_text, from texts (key, text): what stands between head and tail."""
    from spanforge.functions.text import between

    return relations.join(texts.select(key, F.col("text").alias("_text")), key).withColumn("evidence_text", between("_text", "head.end", "tail.start")).drop("_text")
