"""Tables of contents from relations: nested items, organisation ids, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import text as T
from spanforge.functions import vocabulary as V

_LABELLED = "struct<text: string, label: string>"


def _named(c: str) -> Column:
    return F.struct(F.col(f"{c}.text").alias("text"), F.col(f"{c}.label").alias("label"))


def _in_order(value: Column) -> Column:
    """Values of a group in the order of ord."""
    return F.transform(F.array_sort(F.collect_list(F.struct("ord", value.alias("v")))), lambda x: x["v"])


def items_by_star(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """One item for each paragraph: flat (org, docs), or starred (top_org, sub_orgs of org and docs).

    Sub-organisations of the same text are one and share their titles.
    Paragraphs without an organisation's title are left out.
    """
    is_title, is_star = (F.col("kind") == V.ORG_TITLE) & (F.col("head.label") == V.ORG), F.col("kind") == V.STAR_ORG
    rows = relations.where(is_title | is_star).select(key, "paragraph_id", F.when(is_star, F.col("tail.text")).otherwise(F.col("head.text")).alias("org_text"), "ord", is_star.alias("star"), _named("head").alias("head"), _named("tail").alias("tail"))
    star, title = F.when(F.col("star"), F.col("ord")), F.when(~F.col("star"), F.col("ord"))
    docs = F.transform(F.array_sort(F.collect_list(F.when(~F.col("star"), F.struct("ord", F.col("tail").alias("v"))))), lambda x: x["v"])
    orgs = rows.groupBy(key, "paragraph_id", "org_text").agg(docs.alias("docs"), F.min(title).alias("titled"), F.min_by("head", title).alias("org"), F.min(star).alias("starred"), F.min_by("head", star).alias("top_org"))
    one = F.struct(F.struct(F.col("org_text").alias("text"), F.lit(V.ORG).alias("label")).alias("org"), "docs")
    subs = F.transform(F.array_sort(F.collect_list(F.when(F.col("starred").isNotNull(), F.struct(F.col("starred").alias("ord"), one.alias("v"))))), lambda x: x["v"])
    items = orgs.groupBy(key, "paragraph_id").agg(F.min_by(F.struct("org", "docs"), "titled").alias("flat"), F.min_by("top_org", "starred").alias("top_org"), subs.alias("sub_orgs"))
    flat = F.col("top_org").isNull()
    return items.select(key, "paragraph_id", F.when(flat, F.col("flat.org")).alias("org"), F.when(flat, F.col("flat.docs")).alias("docs"), "top_org", F.when(~flat, F.col("sub_orgs")).alias("sub_orgs"))


def title_orgs(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct organisations of a document with ids from 1, in the order first seen: key, id, text, label."""
    heads = relations.where(F.col("kind").isin(V.ORG_TITLE, V.STAR_TITLE, V.ORG_BODY, V.ORG_PARAGRAPH) & F.col("head.label").isin(V.ORG, V.ORG_STAR))
    first = heads.groupBy(key, F.col("head.text").alias("text"), F.col("head.label").alias("label")).agg(F.min("ord").alias("ord"))
    return first.select(key, F.row_number().over(W.partitionBy(key).orderBy("ord")).alias("id"), "text", "label")


def items_by_title(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """One item for each paragraph: paragraph_id, org_ids, doc_name (or null), children."""
    ids = title_orgs(relations, key).select(F.col(key).alias("_k"), "id", F.col("text").alias("_t"), F.col("label").alias("_l"))
    is_org = F.col("kind").isin(V.ORG_TITLE, V.STAR_TITLE, V.ORG_BODY, V.ORG_PARAGRAPH)
    rows = relations.join(ids, is_org & (F.col(key) == F.col("_k")) & (F.col("head.text") == F.col("_t")) & (F.col("head.label") == F.col("_l")), "left")
    to_title = F.col("kind").isin(V.ORG_TITLE, V.STAR_TITLE)
    child = F.struct(F.col("tail.text").alias("child"), F.lit(V.PARAGRAPH).alias("label"))
    grouped = rows.groupBy(key, "paragraph_id").agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("ord", "id")))), lambda x: x["id"])).alias("org_ids"),
        F.min_by(F.when(to_title, _named("tail")), F.when(to_title, F.col("ord"))).alias("by_org"),
        F.min_by(F.when(F.col("head.label") == V.TITLE, _named("head")), F.when(F.col("head.label") == V.TITLE, F.col("ord"))).alias("by_head"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isin(V.TITLE_BODY, V.TITLE_PARAGRAPH), F.struct("ord", child.alias("v"))))).alias("under_title"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isin(V.ORG_BODY, V.ORG_PARAGRAPH), F.struct("ord", child.alias("v"))))).alias("under_org"),
    )
    name = F.coalesce("by_org", "by_head")
    return grouped.select(key, "paragraph_id", "org_ids", name.alias("doc_name"), F.when(name.isNotNull(), F.col("under_title.v")).otherwise(F.col("under_org.v")).alias("children"))


def allowed_children(items: DataFrame, key: str = "doc_id", item: str = "item") -> DataFrame:
    """The titles that may head a part of an item: key, item, ord, title.

    Taken, as far as items has them, from allowed_children (texts), children
    (structs with the first filled of doc_name.text, text, child) and bodies
    (doc_name.text); normalised, of those with one key without spaces the first.
    """
    texts = F.array().cast("array<string>")

    def fields(column: str, *paths: str) -> Column:
        kind = items.schema[column].dataType.elementType
        have = [p for p in paths if p.split(".")[0] in kind.names and (("." not in p) or p.split(".")[1] in getattr(kind[p.split(".")[0]].dataType, "names", []))]
        one = lambda x: F.coalesce(*(F.nullif(_at(x, p), F.lit("")) for p in have)) if have else F.lit(None).cast("string")
        return F.coalesce(F.transform(column, one), texts)

    parts = []
    if "allowed_children" in items.columns:
        parts.append(F.coalesce("allowed_children", texts))
    if "children" in items.columns:
        parts.append(fields("children", "doc_name.text", "text", "child"))
    if "bodies" in items.columns:
        parts.append(fields("bodies", "doc_name.text"))
    rows = items.select(key, item, F.posexplode(F.concat(*parts) if parts else texts).alias("ord", "_raw")).select(key, item, "ord", T.title_norm("_raw").alias("title"))
    first = W.partitionBy(key, item, F.lower(T.tighten("title"))).orderBy("ord")
    return rows.where("title <> ''").withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def _at(x: Column, path: str) -> Column:
    for name in path.split("."):
        x = x[name]
    return x


def compact(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """Six columns of a flat export, in order."""
    return relations.select(key, "ord", "paragraph_id", "kind", F.col("head.label").alias("head_label"), F.col("head.text").alias("head_text"), F.col("tail.label").alias("tail_label"), F.col("tail.text").alias("tail_text"))


def grouped_json(relations: DataFrame, key: str = "doc_id", full: bool = False) -> DataFrame:
    """key, json: {"paragraphs": [{"paragraph_id", "relations": [...]}]}; full keeps offsets and evidence."""
    one = F.struct("kind", "head", "tail", *(["evidence_text"] if "evidence_text" in relations.columns else [])) if full else F.struct("kind", _named("head").alias("head"), _named("tail").alias("tail"))
    by = relations.groupBy(key, "paragraph_id").agg(F.min("ord").alias("ord"), _in_order(one).alias("relations"))
    return by.groupBy(key).agg(F.to_json(F.struct(_in_order(F.struct("paragraph_id", "relations")).alias("paragraphs")), {"ignoreNullFields": "false"}).alias("json"))


def by_head(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, paragraph_id, head_ord, head, relations: for each kind, in the fixed order, the tails of a head; other kinds are left out."""
    rank = F.array_position(F.array(*(F.lit(k) for k in V.KIND_ORDER)), F.col("kind"))
    tails = relations.where(rank > 0).groupBy(key, "paragraph_id", _named("head").alias("head"), "kind").agg(_in_order(_named("tail")).alias("tails"), F.min("ord").alias("first"))
    kinds = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "kind", "tails")))
    return tails.groupBy(key, "paragraph_id", "head").agg(F.min("first").alias("head_ord"), F.transform(kinds, lambda x: F.struct(x["kind"].alias("kind"), x["tails"].alias("tails"))).alias("relations"))
