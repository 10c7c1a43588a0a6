"""Splitting a document at its repeated heading; slicing its body by headings and titles.

Spans are rows (key, seq, label, text, start, end); texts are rows (key, text).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import predicates as P
from spanforge.functions import text as T
from spanforge.functions import vocabulary as V
from spanforge.operators.relations import ORGS, paragraphs_by_star
from spanforge.operators.similarity import contained_pairs, similar_pairs
from spanforge.sources.staging import dropped, staged

#: The made-up organisation of a table of contents without any.
NO_ORG_ID, NO_ORG = -1, "(Sem organização)"


def split_at_repeat(spans: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each of keys (key, n_chars): reason, marker_end, first_org, boundary, ranges of summary and body.

    The summary begins after the last marker; the body at the first later heading
    with the letters of the first heading, else at the first one whose letters
    are a shorter part of it.
    """
    w = W.partitionBy(key)
    rows = spans.where(F.col("label").isin(V.SUMMARY, *ORGS)).withColumn("letters", T.letters_key("text"))
    ends = rows.withColumn("marker_end", F.max_by(F.when(F.col("label") == V.SUMMARY, F.col("end")), F.when(F.col("label") == V.SUMMARY, F.col("seq"))).over(w))
    orgs = ends.withColumn("first", F.min(F.when(F.col("label").isin(ORGS) & (F.col("start") >= F.col("marker_end")), F.struct("start", "text", "letters"))).over(w))
    later = F.col("label").isin(ORGS) & (F.col("start") > F.col("first.start"))
    same = later & (F.col("letters") == F.col("first.letters"))
    part = later & F.contains(F.col("first.letters"), F.col("letters")) & (F.length("letters") < F.length("first.letters"))
    found = orgs.groupBy(key).agg(F.max("marker_end").alias("marker_end"), F.max("first").alias("first"), F.min(F.when(same, F.col("start"))).alias("exact"), F.min(F.when(part, F.col("start"))).alias("part"))
    boundary = F.coalesce("exact", "part")
    reason = F.when(F.col("marker_end").isNull(), "no_sumario").when(F.col("first").isNull(), "no_org_after_sumario").when(boundary.isNull(), "no_repeat_match")
    body_start = F.when(F.col("marker_end").isNull(), 0).otherwise(F.coalesce(boundary, F.col("n_chars")))
    return keys.join(found, key, "left").select(key, reason.alias("reason"), "marker_end", F.col("first.text").alias("first_org"), boundary.alias("boundary"), F.col("marker_end").alias("summary_start"), F.when(F.col("marker_end").isNotNull(), body_start).alias("summary_end"), body_start.alias("body_start"), F.col("n_chars").alias("body_end"))


def slices(anchors: DataFrame, ends: DataFrame, key: str = "doc_id", within: list[str] | None = None) -> DataFrame:
    """anchors (key, start, ...) with stop: the next anchor's start, or the end in ends (key, n_chars)."""
    w = W.partitionBy(key, *(within or [])).orderBy("start")
    return anchors.withColumn("after", F.lead("start").over(w)).join(ends, key).withColumn("stop", F.coalesce("after", "n_chars")).drop("after", "n_chars")


def within(points: DataFrame, ranges: DataFrame, key: str, at: str = "start", kept: list[str] | None = None) -> DataFrame:
    """points (key, at, ...) with the range that holds them: the columns kept of ranges (key, start, stop, ...), null outside.

    Ranges of a key do not overlap, so this is one ordered stream of both, in
    which the last range that began is looked at: no join, and no pairs.
    """
    own = [c for c in points.columns if c != key]
    kept = kept or ["start", "stop"]
    opened = ranges.select(F.col(key).alias("_k"), F.col("start").cast("long").alias("_at"), F.lit(0).alias("_o"), F.lit(None).cast(points.select(F.struct(*own)).schema[0].dataType).alias("_row"), F.col("stop").alias("_stop"), F.struct(*kept).alias("_range"))
    rows = points.select(F.col(key).alias("_k"), F.col(at).cast("long").alias("_at"), F.lit(1).alias("_o"), F.struct(*own).alias("_row"), F.lit(None).cast(ranges.schema["stop"].dataType).alias("_stop"), F.lit(None).cast(ranges.select(F.struct(*kept)).schema[0].dataType).alias("_range"))
    w = W.partitionBy("_k").orderBy("_at", "_o").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_o") == 0, F.struct("_stop", "_range")), ignorenulls=True).over(w)
    stream = opened.unionByName(rows).withColumn("_last", last).where("_o = 1")
    inside = F.when(F.col("_at") < F.col("_last._stop"), F.col("_last._range"))
    return stream.select(F.col("_k").alias(key), "_row.*", *(inside[c].alias(f"_{c}") for c in kept))


def headings(spans: DataFrame, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Headings (key, label, text, start, end) with name, their key, and gap: what stands up to the next one if that may be within a name, else null."""
    after = F.lead("start").over(W.partitionBy(key).orderBy("start"))
    rows = spans.where(F.col("label").isin(ORGS)).select(key, "label", "text", "start", "end", T.org_key("text").alias("name"), after.alias("_after")).join(texts.select(key, F.col("text").alias("_text")), key)
    between = rows.withColumn("gap", F.substring("_text", (F.col("end") + 1).cast("int"), (F.col("_after") - F.col("end")).cast("int"))).drop("_text", "_after")
    return between.withColumn("gap", F.when(P.is_name_gap("gap"), F.col("gap")))


def coalesced_anchors(spans: DataFrame, texts: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Headings, up to MAX_MERGE neighbours as one, whose key is wanted: key, start, end, org_key, label, width, text.

    wanted: rows (key, org_key).  From left to right the longest merge wins and
    the next one begins after it.
    """
    return merged_headings(headings(spans, texts, key), wanted, key)


def merged_headings(heads: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """coalesced_anchors() of headings().  A key has letters and digits only, so that of a merge is those of its parts put together: no text is looked at."""
    w = W.partitionBy(key).orderBy("start")
    more = range(1, V.MAX_MERGE)
    sets = wanted.where("org_key <> ''").groupBy(key).agg(F.collect_set("org_key").alias("_keys"))
    rows = heads.select(key, "label", "text", "start", "end", "name", "gap", F.row_number().over(w).alias("i"), *(F.lead(c, n).over(w).alias(f"{c}{n}") for n in more for c in ("text", "end", "name", "gap"))).join(sets, key)
    gaps, names, shown = ["gap", *(f"gap{n}" for n in more)], [F.col("name")], [F.col("text")]
    for n in more:
        names.append(F.concat(names[-1], F.col(f"name{n}")))
        shown.append(F.concat(shown[-1], F.col(gaps[n - 1]), F.col(f"text{n}")))
    width, good = F.lit(0), F.lit(True)
    for n, name in enumerate(names):
        good = good & F.col(gaps[n - 1]).isNotNull() if n else good
        width = F.when(F.array_contains("_keys", name) & good, n + 1).otherwise(width)
    of = lambda values: F.element_at(F.array(*values), F.col("width"))
    found = rows.withColumn("width", width).where("width > 0")
    candidates = found.select(key, F.struct("i", "width", "start", of(["end", *(f"end{n}" for n in more)]).alias("end"), of(names).alias("org_key"), "label", of(shown).alias("text")).alias("c"))
    lists = candidates.groupBy(key).agg(F.array_sort(F.collect_list("c")).alias("all"))
    empty = F.struct(F.lit(0).alias("next"), F.filter("all", lambda x: F.lit(False)).alias("kept"))

    def step(state: Column, c: Column) -> Column:
        taken = F.struct((c["i"] + c["width"]).alias("next"), F.array_append(state["kept"], c).alias("kept"))
        return F.when(c["i"] >= state["next"], taken).otherwise(state)

    return lists.select(key, F.inline(F.aggregate("all", empty, step, lambda s: s["kept"]))).select(key, "start", "end", "org_key", "label", "width", "text")


def ordered_match(headers: Column, wanted: Column) -> Column:
    """For each wanted text the index (from 0) of its header, or -1, in order: each search goes on after the last hit, and a miss uses up the rest."""
    size = F.size(headers)
    empty = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("found"))

    def step(state: Column, text: Column) -> Column:
        at = F.array_position(F.slice(headers, state["next"] + 1, F.greatest(size, F.lit(1))), text).cast("int")
        hit = state["next"] + at - 1
        return F.when(at > 0, F.struct((hit + 1).alias("next"), F.array_append(state["found"], hit).alias("found"))).otherwise(F.struct(size.alias("next"), F.array_append(state["found"], F.lit(-1)).alias("found")))

    return F.aggregate(wanted, empty, step, lambda s: s["found"])


def doc_slices(blocks: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """blocks (key, block, start, stop, docs: texts wanted) with status and slices (doc_name, start, stop).

    Blocks of a key are the same or apart.  No title and one text wanted: the
    whole block.  Titles are matched in order;
    where none matches, all are sliced.  Status: ok, partial or doc_missing.
    """
    heads = spans.where(F.col("label") == V.TITLE).select(key, F.col("start").alias("_at"), F.col("text").alias("_title"))
    placed = within(heads, blocks.select(key, "start", "stop").distinct(), key, "_at").where("_start is not null").select(F.col(key).alias("_k"), "_at", "_title", "_start")
    inside = blocks.join(placed, (F.col(key) == F.col("_k")) & (F.col("start") == F.col("_start")), "left")
    rows = inside.groupBy(key, "block", "start", "stop", "docs").agg(F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct(F.col("_at").alias("at"), F.col("_title").alias("title"))))).alias("heads"))
    titles = F.transform("heads", lambda h: T.plain_text(h["title"]))
    rows = rows.withColumn("hits", ordered_match(titles, F.transform("docs", lambda d: T.plain_text(d))))

    def cut(i: Column, name: Column) -> Column:
        end = F.coalesce(F.try_element_at("heads", i + 2)["at"], F.col("stop"))
        return F.struct(T.strip_bold(name).alias("doc_name"), F.element_at("heads", i + 1)["at"].alias("start"), end.alias("stop"))

    matched = F.filter(F.transform("docs", lambda d, n: F.struct(d.alias("d"), F.element_at("hits", n + 1).alias("i"))), lambda x: x["i"] >= 0)
    by_name = F.transform(matched, lambda x: cut(x["i"], x["d"]))
    every = F.transform("heads", lambda h, n: cut(n, h["title"]))
    whole = F.array(F.struct(T.strip_bold(F.element_at("docs", 1)).alias("doc_name"), F.col("start").alias("start"), F.col("stop").alias("stop")))
    alone = (F.size("heads") == 0) & (F.size("docs") == 1)
    out = F.when(alone, whole).when(F.size(by_name) > 0, by_name).otherwise(every)
    missed = F.when(alone, 0).when(F.size(by_name) > 0, F.size("docs") - F.size(by_name)).otherwise(F.size("docs"))
    status = F.when(F.size("docs") == 0, "ok").when((F.size("slices") > 0) & (F.col("missed") > 0), "partial").when(F.size("slices") == 0, "doc_missing").otherwise("ok")
    return rows.withColumn("slices", out).withColumn("missed", missed).withColumn("status", status).drop("heads", "hits")


def segment_flat(spans: DataFrame, texts: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each item (key, item, org_text, docs) of a table of contents: status, start, stop, slices.

    An item is matched by key to the first block of its organisation; without
    one its status is org_missing.
    """
    wanted = items.select(key, T.org_key("org_text").alias("org_key")).distinct()
    anchors = coalesced_anchors(spans, texts, wanted, key)
    blocks = slices(anchors, texts.select(key, F.length("text").alias("n_chars")), key)
    first = blocks.groupBy(key, "org_key").agg(F.min(F.struct("start", "stop")).alias("b"))
    matched = items.withColumn("org_key", T.org_key("org_text")).join(first, [key, "org_key"], "left").select(key, F.col("item").alias("block"), "org_text", "docs", F.col("b.start").alias("start"), F.col("b.stop").alias("stop"))
    cut = doc_slices(matched.where("start is not null").drop("org_text"), spans, key).select(key, "block", "slices", "missed", "status")
    out = matched.join(cut, [key, "block"], "left")
    return out.select(key, F.col("block").alias("item"), "org_text", F.coalesce("status", F.lit("org_missing")).alias("status"), "start", "stop", F.size("docs").alias("n_docs"), F.coalesce("missed", F.size("docs")).alias("n_missed"), "slices", F.coalesce(F.size("slices"), F.lit(0)).alias("n_slices"))


def segment_nested(spans: DataFrame, texts: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each sub-organisation of starred items (key, item, top_text, sub, sub_text, docs): status, start, stop, slices (doc_name, start, stop).

    Within the first block of the item's top organisation, headings (up to
    MAX_MERGE neighbours as one) with the key of any sub-organisation are cut
    from one to the next.  Each place of a sub-organisation is a slice of its
    own; the n-th takes the name of the n-th document, further ones keep their
    heading.  Status: ok if there are as many slices as documents, else partial;
    org_missing without a place.
    """
    every = staged(headings(spans, texts, key), "headings")
    tops = segment_tops(every, texts, items, key).withColumn("_id", F.concat_ws("/", F.col(key).cast("string"), F.col("item").cast("string")))
    tops = staged(tops, "tops")  # each of the steps below reads it
    ranges = tops.select(key, F.col("top_start").alias("start"), F.col("top_stop").alias("stop")).distinct()
    placed = within(every, ranges, key).where("_start is not null")
    heads = placed.join(tops, (placed[key] == tops[key]) & (F.col("_start") == F.col("top_start"))).select("_id", "label", "text", "start", "end", "name", "gap")
    subs = items.select(key, "item", "sub", "sub_text", "docs", T.org_key("sub_text").alias("org_key")).join(tops, [key, "item"], "left")
    anchors = merged_headings(heads, subs.where("_id is not null").select("_id", "org_key").distinct(), "_id")
    places = slices(anchors, tops.select("_id", F.col("top_stop").alias("n_chars")), "_id")
    found = places.groupBy("_id", "org_key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "text"))).alias("at"))
    rows = subs.join(found, ["_id", "org_key"], "left")
    name = lambda x, n: F.when(n < F.size("docs"), F.try_element_at("docs", n + 1)).otherwise(x["text"])
    cut = F.transform(F.coalesce("at", F.array().cast("array<struct<start:bigint,stop:bigint,text:string>>")), lambda x, n: F.struct(T.strip_bold(name(x, n)).alias("doc_name"), x["start"].alias("start"), x["stop"].alias("stop")))
    n_docs, n_slices = F.size("docs"), F.size("slices")
    status = F.when(n_slices == 0, "org_missing").when(n_slices == n_docs, "ok").otherwise("partial")
    named = rows.withColumn("slices", cut).withColumn("status", status)
    return named.select(key, "item", "sub", "sub_text", "docs", "status", F.try_element_at("slices", F.lit(1))["start"].alias("start"), F.try_element_at("slices", F.lit(-1))["stop"].alias("stop"), n_docs.alias("n_docs"), F.greatest(n_docs - n_slices, F.lit(0)).alias("n_missed"), n_slices.alias("n_slices"), "slices", F.col("_id").isNotNull().alias("top_found"))


def segment_tops(heads: DataFrame, texts: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first block, among headings(), of each starred item's top organisation: key, item, top_start, top_stop."""
    wanted = items.select(key, T.org_key("top_text").alias("org_key")).distinct()
    blocks = slices(merged_headings(heads, wanted, key), texts.select(key, F.length("text").alias("n_chars")), key)
    first = blocks.groupBy(key, "org_key").agg(F.min(F.struct("start", "stop")).alias("b"))
    return items.select(key, "item", T.org_key("top_text").alias("org_key")).distinct().join(first, [key, "org_key"]).select(key, "item", F.col("b.start").alias("top_start"), F.col("b.stop").alias("top_stop"))


def summary(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counters of each document over its segments, flat or nested (those have top_found), in two families.

    The plain ones count what is so: documents that the contents name, and those
    of them that have a slice.  Those with _ref count slices, whatever named
    them, no documents of a missing top organisation, and of nested segments
    neither ok nor partial ones.
    """
    found = F.col("top_found") if "top_found" in segments.columns else F.lit(None).cast("boolean")
    status = lambda s, also=None: F.count_if((F.col("status") == s) & (F.lit(True) if also is None else also))
    return segments.groupBy(key).agg(
        F.count(F.lit(1)).alias("orgs_total"),
        *(status(s).alias(n) for s, n in (("ok", "org_ok"), ("partial", "org_partial"), ("doc_missing", "org_doc_missing"), ("org_missing", "org_missing"))),
        F.sum(F.col("n_docs").cast("long")).alias("docs_expected"),
        F.sum((F.col("n_docs") - F.col("n_missed")).cast("long")).alias("docs_matched"),
        status("ok", found.isNull()).alias("org_ok_ref"),
        status("partial", found.isNull()).alias("org_partial_ref"),
        F.sum(F.when(F.coalesce(found, F.lit(True)), F.col("n_docs")).otherwise(0).cast("long")).alias("docs_expected_ref"),
        F.sum(F.col("n_slices").cast("long")).alias("docs_matched_ref"),
    )


def losses_starred(spans: DataFrame, items: DataFrame, nested: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the rules for starred contents drop, a row each: key, reason, item, sub, name.

    before_org: a title or text of a starred paragraph above its first plain
    heading, which gets no relation.  beside_starred: a document of a flat item,
    of contents that have a starred one.  top_missing, org_missing: a document
    whose top organisation, or own one, is not in the body.  unmatched: a
    document beyond the places of its organisation.

    spans are those of the contents; items as items_by_star() gives them; nested
    as segment_nested(), with docs.
    """
    heading = F.last(F.when(F.col("label").isin(ORGS), F.col("label")), ignorenulls=True).over(W.partitionBy(key).orderBy("seq").rowsBetween(W.unboundedPreceding, 0))
    placed = paragraphs_by_star(spans, key).withColumn("_under", heading)
    columns = lambda reason, item, sub, name: [key, F.lit(reason).alias("reason") if isinstance(reason, str) else reason.alias("reason"), item.cast("int").alias("item"), sub.cast("int").alias("sub"), name.alias("name")]
    none = F.lit(None)
    above = placed.where((F.col("_under") == V.ORG_STAR) & F.col("label").isin(V.TITLE, V.BODY, V.PARAGRAPH)).select(*columns("before_org", F.col("paragraph_id"), none, F.col("text")))
    starred = items.where("top_org is not null").select(key).distinct()
    flat = items.where("org is not null").join(starred, key, "left_semi").select(key, F.col("paragraph_id"), F.explode("docs.text").alias("_name")).select(*columns("beside_starred", F.col("paragraph_id"), none, F.col("_name")))
    reason = F.when(~F.col("top_found"), "top_missing").when(F.col("status") == "org_missing", "org_missing").otherwise("unmatched")
    missed = nested.where("n_missed > 0").select(key, "item", "sub", reason.alias("_reason"), F.explode(F.slice("docs", F.col("n_docs") - F.col("n_missed") + 1, F.col("n_missed"))).alias("_name"))
    return above.unionByName(flat).unionByName(missed.select(*columns(F.col("_reason"), F.col("item"), F.col("sub"), F.col("_name"))))


def losses_titled(items: DataFrame, located: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the rules for title-driven contents drop, a row each: key, reason, item, name.

    no_org: an item without organisations, which claims its title but is in no
    result.  unanchored: one whose title is not found.
    """
    there = located.select(key, "item").distinct().withColumn("_there", F.lit(True))
    rows = items.join(there, [key, "item"], "left")
    reason = F.when(F.size("org_ids") == 0, "no_org").when(~_untitled("title") & F.col("_there").isNull(), "unanchored")
    return rows.withColumn("reason", reason).where("reason is not null").select(key, "reason", "item", F.col("title").alias("name"))


def header_blocks(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Islands of titles with nothing between: key, start, end, headers; body_stop is the next island's start."""
    w = W.partitionBy(key).orderBy("seq")
    is_title = F.col("label") == V.TITLE
    begins = is_title & ~F.coalesce(F.lag(is_title).over(w), F.lit(False))
    runs = spans.withColumn("run", F.sum(begins.cast("int")).over(w)).where(is_title)
    grouped = runs.groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("seq", "text")))["text"].alias("headers"))
    return grouped.withColumn("body_stop", F.lead("start").over(W.partitionBy(key).orderBy("start"))).drop("run")


def title_keys(c: str) -> list[Column]:
    """The three equality keys of a title: exact, tight, letters."""
    exact = T.casefold(T.title_norm(c))
    return [exact, T.tighten(exact), T.ascii_letters(T.title_norm(c))]


def _kth_with_kth(rows: DataFrame, name: str, distinct: bool) -> DataFrame:
    """rows (_k, _side, _id, keys, _other, _used, confidence) with the k-th free row of side 0 and of side 1 of each value of a key matched to each other.

    One shuffle: both sides lie in one window by document and value, which the
    window of equal k shares; rows that are matched, or have no value, are windows
    of their own.  Unless ids are distinct, a second one uses up all rows of an id
    that is matched.
    """
    free = ~F.col("_used") & F.coalesce(F.col(name) != "", F.lit(False))
    rows = rows.withColumn("_v", F.when(free, F.concat(F.lit("="), F.col(name))).otherwise(F.concat_ws("#", F.lit(""), "_side", F.col("_id").cast("string"))))
    w = W.partitionBy("_k", "_v")
    before = F.when(F.col("_side") == 1, F.count_if(F.col("_side") == 0).over(w)).otherwise(0)
    rows = rows.withColumn("_n", F.row_number().over(w.orderBy("_side", "_id")) - before)
    same = W.partitionBy("_k", "_v", "_n")
    partner = F.when(F.col("_side") == 0, F.max(F.when(F.col("_side") == 1, F.col("_id"))).over(same)).otherwise(F.max(F.when(F.col("_side") == 0, F.col("_id"))).over(same))
    hit = rows.withColumn("_hit", F.when(F.col("_v").startswith("="), partner))
    matched = hit.withColumn("confidence", F.when(F.col("_hit").isNotNull(), V.CONFIDENCE[name]).otherwise(F.col("confidence"))).withColumn("_other", F.coalesce("_other", "_hit")).drop("_v", "_n", "_hit")
    used = F.col("_other").isNotNull()
    return matched.withColumn("_used", used if distinct else F.max(used).over(W.partitionBy("_k", "_side", "_id")))


def best_places(edges: DataFrame, key: str) -> DataFrame:
    """Of edges (key, a, b, ratio, size) those that a greedy assignment takes: the a of the greatest size first (ties: the least), each its b of the greatest ratio (ties: the least) that is still free.

    As all b prefer the same a, this is what deferred acceptance gives: each a
    asks its best b; a b drops all edges that it would decline for the best that
    asks it; until nothing is dropped.  Rounds are as many as declined wishes
    follow on one another, and every round is a job over all documents at once.
    """
    edges = staged(edges, "edges")
    n = edges.count()
    while n:
        asked = F.row_number().over(W.partitionBy(key, "a").orderBy(F.desc("ratio"), "b")) == 1
        rank = F.struct((-F.col("size")).alias("less"), "a")
        cut = F.min(F.when(F.col("asked"), rank)).over(W.partitionBy(key, "b"))
        kept = staged(edges.withColumn("asked", asked).withColumn("cut", cut).where(F.col("cut").isNull() | (rank <= F.col("cut"))), "edges")
        dropped(edges)
        left = kept.count()
        if left == n:
            return kept.where("asked").drop("asked", "cut")
        edges, n = kept.drop("asked", "cut"), left
        edges._spanforge_path = kept._spanforge_path
    return edges


def title_matches(wanted: DataFrame, titles: DataFrame, key: str = "doc_id", contained: bool = True, distinct: bool = False) -> DataFrame:
    """wanted (key, item, title) matched one to one to titles (key, start, title): key, item, start, confidence.

    Passes by exact, tight and letters keys match the k-th wanted title of a key
    to its k-th free place, which is what a first-free scan gives: both sides are
    one table, and a pass is one shuffle of it.  Titles that share a start are one
    place, which is used up with any of them (so are items); with distinct there
    are none, and no shuffle for them.  What is left may be contained in
    one another with a ratio of lengths of LEAST_RATIO: the longest wanted title
    first, each taking its best free place.
    """
    names = list(V.CONFIDENCE)
    keys = [k.alias(n) for k, n in zip(title_keys("title"), names[:3], strict=True)]
    side = lambda rows, c, n: rows.select(F.col(key).alias("_k"), F.lit(n).alias("_side"), F.col(c).cast("long").alias("_id"), *keys, F.lit(None).cast("long").alias("_other"), F.lit(False).alias("_used"), F.lit(None).cast("double").alias("confidence"))
    rows = side(wanted, "item", 0).unionByName(side(titles, "start", 1))
    for name in names[:3]:
        rows = _kth_with_kth(rows, name, distinct)
    kinds = [F.col("_k").alias(key), F.col("a").cast(wanted.schema["item"].dataType).alias("item"), F.col("b").cast(titles.schema["start"].dataType).alias("start"), "confidence"]
    hits = lambda of: of.where("_side = 0 and _other is not null").select("_k", F.col("_id").alias("a"), F.col("_other").alias("b"), "confidence").select(*kinds)
    if not contained:
        return hits(rows)
    rows = staged(rows.select("_k", "_side", "_id", "letters", "_other", "_used", "confidence"), "title-rows")
    free = [rows.where(f"not _used and _side = {n} and letters <> ''").select("_k", F.col("_id").alias(c), F.col("letters").alias(f"_{c}")) for n, c in ((0, "a"), (1, "b"))]
    near = contained_pairs(*(f.select("_k", F.col(f"_{c}").alias("letters")).distinct() for f, c in zip(free, "ab", strict=True)), "_k")
    near = near.select(F.col("_k").alias("_nk"), F.col("a").alias("_na"), F.col("b").alias("_nb"), "ratio")
    edges = free[0].join(near, (F.col("_k") == F.col("_nk")) & (F.col("_a") == F.col("_na"))).select("_k", "a", F.length("_a").alias("size"), "_nb", "ratio")
    edges = edges.join(free[1].withColumnRenamed("_k", "_bk"), (F.col("_k") == F.col("_bk")) & (F.col("_nb") == F.col("_b"))).select("_k", "a", "b", "ratio", "size")
    rest = best_places(edges, "_k").select("_k", "a", "b", (F.col("ratio") * V.CONFIDENCE["contained"]).alias("confidence")).select(*kinds)
    return hits(rows).unionByName(rest)


def best_windows(orgs: DataFrame, windows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The window (key, idx, name) of the greatest token Jaccard for each organisation (key, id, text); ties, and no likeness at all, go to the lowest idx.

    Each distinct text of a key is compared with its windows once.  Rows are dealt
    by key and id before they are sorted, so a task's memory does not follow what
    it read.
    """
    best = lambda rows, *by: rows.groupBy(*by).agg(F.max_by(F.struct("idx", "score"), F.struct("score", (-F.col("idx")).alias("low"))).alias("b"))
    names = orgs.select(F.col(key).alias("_k"), F.col("text").alias("_text")).distinct().withColumn("_words", T.tokens("_text"))
    pairs = names.join(windows.withColumn("_name_words", T.tokens("name")), F.col("_k") == F.col(key)).withColumn("score", T.jaccard("_words", "_name_words"))
    found = best(pairs, "_k", "_text").select("_k", "_text", F.col("b.idx").alias("idx"), F.col("b.score").alias("score"))
    rows = orgs.join(found, (F.col(key) == F.col("_k")) & F.col("text").eqNullSafe(F.col("_text"))).select(key, "id", "idx", "score").repartition(key, "id")
    return best(rows, key, "id").select(key, "id", F.col("b.idx").alias("idx"), F.col("b.score").alias("score"), F.when(F.col("b.score") > 0, "org_anchored").otherwise("org_unanchored").alias("status"))


def first_of_names(windows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first of the windows (key, idx, name) of each name: as ties go to the lowest idx, no other is ever best."""
    return windows.groupBy(key, "name").agg(F.min("idx").alias("idx"))


def kept_windows(spans: DataFrame, orgs: DataFrame, ends: DataFrame, key: str = "doc_id") -> DataFrame:
    """Windows of plain headings that match an organisation (tight containment, or two shared words): key, idx, name, start, stop; one global window where none does."""
    heads = spans.where(F.col("label") == V.ORG).select(key, "start", F.col("text").alias("name"))
    allowed = orgs.where(F.col("id") != NO_ORG_ID).where(T.unwrapped("text") != "").groupBy(key).agg(F.collect_set(T.unwrapped("text")).alias("_orgs"))
    tight = lambda c: F.lower(T.tighten(c))
    name = T.unwrapped("name")
    alike = F.exists("_orgs", lambda o: F.contains(tight(name), tight(o)) | F.contains(tight(o), tight(name)) | (F.size(F.array_intersect(T.tokens(name), T.tokens(o))) >= 2))
    kept = slices(heads.join(allowed, key).where(alike).drop("_orgs"), ends, key)
    numbered = kept.withColumn("idx", F.row_number().over(W.partitionBy(key).orderBy("start")) - 1)
    none = ends.join(kept.select(key).distinct(), key, "left_anti").select(key, F.lit(0).cast("bigint").alias("start"), F.lit("(global)").alias("name"), F.col("n_chars").alias("stop"), F.lit(0).alias("idx"))
    return numbered.select(key, "start", "name", "stop", "idx").unionByName(none.select(key, F.col("start"), "name", "stop", "idx"))


def bounded_by_window(starts: DataFrame, windows: DataFrame, ends: DataFrame, key: str = "doc_id") -> DataFrame:
    """starts (key, start, ...) with idx, the window they lie in, and stop: the next start in that window, or its end; without a window (idx null) the end in ends (key, n_chars)."""
    inside = within(starts, windows.select(key, "idx", "start", "stop"), key, kept=["idx", "stop"]).withColumnRenamed("_idx", "idx")
    w = W.partitionBy(key, "idx").orderBy("start")
    stop = F.when(F.col("idx").isNull(), F.col("n_chars")).otherwise(F.coalesce(F.lead("start").over(w), "_stop"))
    return inside.join(ends, key).withColumn("stop", stop).drop("_stop", "n_chars")


def located_titles(spans: DataFrame, windows: DataFrame, ends: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """The titles of items (key, item, title) found in a body: key, item, idx, confidence, header_start, start (the header's end), stop."""
    titles = spans.where(F.col("label") == V.TITLE).select(key, "start", "end", F.col("text").alias("title"))
    matched = title_matches(items.where(~_untitled("title")).select(key, "item", "title"), titles.drop("end"), key, distinct=True)
    bounded = bounded_by_window(matched, windows, ends, key).join(titles.select(key, "start", "end"), [key, "start"])
    return bounded.select(key, "item", "idx", "confidence", F.col("start").alias("header_start"), F.col("end").alias("start"), "stop")


def _untitled(c: str) -> Column:
    return F.coalesce(T.title_norm(c), F.lit("")) == ""


def org_map(orgs: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """orgs (key, id, text), and for each of docs (key) that has none one made-up organisation."""
    none = docs.select(key).distinct().join(orgs.select(key).distinct(), key, "left_anti")
    made_up = none.select(key, F.lit(NO_ORG_ID).alias("id"), F.lit(NO_ORG).alias("text"))
    return orgs.withColumn("id", F.col("id").cast("int")).withColumn("text", F.trim("text")).unionByName(made_up, allowMissingColumns=True)


def segment_titles(spans: DataFrame, texts: DataFrame, orgs: DataFrame, items: DataFrame, key: str = "doc_id", located: DataFrame | None = None, windows: DataFrame | None = None) -> DataFrame:
    """Segments of a title-driven body: key, item, org_id, title, status, confidence, start, stop.

    items (key, item, org_ids, title or null); orgs (key, id, text).  A title
    that is matched gives what stands between its header and the next matched
    title of its window, or the end of that window, or of the text if it is in
    none.  An item without a title, or with one that normalises to nothing, takes
    its organisation's whole window; an item without organisations claims its
    title, but is in no result.
    """
    ends = texts.select(key, F.length("text").cast("bigint").alias("n_chars"))
    if windows is None:
        windows = kept_windows(spans, orgs, ends, key)
    if located is None:
        located = located_titles(spans, windows, ends, items, key)
    found = located.select(key, "item", "start", F.greatest("start", "stop").alias("stop"), "confidence")
    anchored = best_windows(orgs, first_of_names(windows, key), key).join(windows.select(key, "idx", F.col("start").alias("w_start"), F.col("stop").alias("w_stop")), [key, "idx"])
    by_org = items.select(key, "item", "title", F.explode("org_ids").alias("id")).join(anchored.select(key, "id", "w_start", "w_stop"), [key, "id"]).join(found, [key, "item"], "left")
    untitled = _untitled("title")
    status = F.when(untitled, "doc_children_segment").when(F.col("start").isNull(), "doc_type_unanchored").otherwise("doc_type_segment")
    title = F.when(untitled, "(Preambulo)").otherwise(T.title_norm("title"))
    return by_org.select(key, "item", F.col("id").alias("org_id"), title.alias("title"), status.alias("status"), F.when(untitled, 0.5).otherwise(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.when(untitled, F.col("w_start")).otherwise(F.col("start")).alias("start"), F.when(untitled, F.col("w_stop")).otherwise(F.col("stop")).alias("stop"))


def likely_children(headers: DataFrame, allowed: DataFrame, key: str = "doc_id") -> DataFrame:
    """For each block of header lines (key, block, line_no, header) the allowed title (key, ord, title) it stands for.

    Passes in order: exact, tight, letters, containment by ratio, trigram
    Jaccard of titles with LEAST_GRAM_LETTERS letters; the first line that
    matches wins, ties go to the first allowed title.
    """
    names = ["exact", "tight", "letters"]
    keyed = lambda rows, c: rows.select("*", *(k.alias(n) for k, n in zip(title_keys(c), names, strict=True)))
    head = staged(keyed(headers, "header").select(key, "block", "line_no", *names), "headers")  # read by each of the passes below
    good = staged(keyed(allowed, "title").select(key, "ord", *names), "allowed")
    found = []
    for rank, name in enumerate(names):  # of equal titles the first one is taken
        first = good.where(F.col(name) != "").groupBy(key, name).agg(F.min("ord").alias("ord"))
        found.append(head.where(F.col(name) != "").join(first, [key, name]).select(key, "block", "line_no", "ord", F.lit(rank).alias("rank"), F.lit(1.0).alias("score")))
    of_head, of_title = (rows.where("letters <> ''").select(key, "letters").distinct() for rows in (head, good))
    within = contained_pairs(of_head, of_title, key).select(key, "a", "b", F.lit(3).alias("rank"), F.col("ratio").alias("score"))
    long = F.length("letters") >= V.LEAST_GRAM_LETTERS
    alike = similar_pairs(of_head.where(long).withColumnRenamed("letters", "a"), of_title.where(long).withColumnRenamed("letters", "b"), key)
    near = within.unionByName(alike.select(key, "a", "b", F.lit(4).alias("rank"), F.col("jaccard").alias("score")))
    titles = good.groupBy(key, F.col("letters").alias("b")).agg(F.min("ord").alias("ord"))
    found.append(head.withColumnRenamed("letters", "a").join(near, [key, "a"]).join(titles, [key, "b"]).select(key, "block", "line_no", "ord", "rank", "score"))
    scored = reduce(DataFrame.unionByName, found)
    best = F.min_by(F.struct("ord", "rank"), F.struct("line_no", "rank", (-F.col("score")).alias("s"), "ord"))
    chosen = scored.groupBy(key, "block").agg(best.alias("b")).select(key, "block", F.col("b.ord").alias("ord"), F.col("b.rank").alias("rank"))
    return chosen.join(allowed.select(key, "ord", "title"), [key, "ord"]).select(key, "block", "title", "rank")


def similar_lines(left: DataFrame, right: DataFrame, least: float = V.LEAST_JACCARD, letters: int = V.LEAST_GRAM_LETTERS) -> DataFrame:
    """Pairs of lines (a, a_line, text) and (b, b_line, text) whose trigram Jaccard is least or more, of those with so many letters."""
    bare = lambda rows, side: rows.select(F.col(side).alias(f"{side}_id"), f"{side}_line", T.ascii_letters("text").alias(side)).where(F.length(side) >= letters)
    found = similar_pairs(bare(left, "a"), bare(right, "b"), least=least)
    return found.select(F.col("a_id").cast("long").alias("a"), F.col("a_line").cast("int").alias("a_line"), F.col("b_id").cast("long").alias("b"), F.col("b_line").cast("int").alias("b_line"), "jaccard")


def sub_slices(segments: DataFrame, allowed: DataFrame, key: str = "doc_id", depth: str = "segment") -> DataFrame:
    """Segments (key, segment, text), labelled again from offset 0, cut at the title blocks that stand for an allowed title (key, segment, ord, title).

    key, segment, sub, title, headers, start, stop: from a block's end to the
    next approved block.  A segment without an approved block is one slice, from
    its first block's end (or its start) to its end, titled by that block's first
    header; empty without one.

    Labelling is dear for its bytes, so texts are dealt out by number first, and
    the blocks, which several steps read, are written once.
    """
    from spanforge.operators.labels import numbered as spans_of

    named = segments.where(F.col("text").isNotNull()).withColumn("_id", F.concat_ws("/", F.col(key).cast("string"), F.col(depth).cast("string")))
    dealt = named.select("_id", "text").repartition(int(named.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_id")
    blocks = header_blocks(spans_of(dealt, "_id"), "_id").select("_id", "start", "end", "headers")
    numbered = staged(blocks.withColumn("block", F.row_number().over(W.partitionBy("_id").orderBy("start"))), "blocks")
    titles = allowed.withColumn("_id", F.concat_ws("/", F.col(key).cast("string"), F.col(depth).cast("string"))).select("_id", "ord", "title")
    lines = numbered.select("_id", "block", F.posexplode("headers").alias("line_no", "header"))
    approved = staged(numbered.join(likely_children(lines, titles, "_id"), ["_id", "block"]), "approved")
    ends = named.select("_id", key, depth, F.length("text").cast("bigint").alias("n_chars"))
    w = W.partitionBy("_id").orderBy("start")
    cut = approved.select("_id", "title", "headers", F.col("end").alias("from"), "start", F.lead("start").over(w).alias("after")).join(ends, "_id")
    good = cut.select("_id", key, depth, "title", "headers", F.col("from").alias("start"), F.coalesce("after", "n_chars").alias("stop"))
    first = numbered.where("block = 1").select("_id", F.col("end").alias("from"), "headers")
    none = ends.join(approved.select("_id").distinct(), "_id", "left_anti").join(first, "_id", "left")
    whole = none.select("_id", key, depth, F.coalesce(T.title_norm(F.try_element_at("headers", F.lit(1))), F.lit("")).alias("title"), F.coalesce("headers", F.array().cast("array<string>")).alias("headers"), F.coalesce("from", F.lit(0)).alias("start"), F.col("n_chars").alias("stop"))
    sub = F.row_number().over(W.partitionBy("_id").orderBy("start"))
    shown = F.transform("headers", lambda h: T.title_norm(h))
    return good.unionByName(whole).withColumn("sub", sub).select(key, depth, "sub", "title", shown.alias("headers"), "start", "stop")


def summary_titles(segments: DataFrame, orgs: DataFrame, windows: DataFrame, subs: DataFrame, located: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counters of title-driven documents.

    doc_type_headers_matched counts items with a header found, whatever their
    organisations; doc_type_segments the segments of all organisations;
    segments_with_subdivisions their sub-slices.
    """
    a = orgs.groupBy(key).agg(F.count(F.lit(1)).alias("orgs_in_payload"))
    b = windows.groupBy(key).agg(F.count(F.lit(1)).alias("org_windows_found"))
    c = located.groupBy(key).agg(F.count(F.lit(1)).alias("doc_type_headers_matched"))
    d = segments.groupBy(key).agg(F.count_if(F.col("status") != "doc_type_unanchored").alias("doc_type_segments"))
    e = subs.groupBy(key).agg(F.count(F.lit(1)).alias("segments_with_subdivisions"))
    out = a.join(b, key, "full").join(c, key, "full").join(d, key, "full").join(e, key, "full").na.fill(0)
    return out.withColumn("segment_reparsed", F.lit(True))
