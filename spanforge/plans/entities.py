"""Queries over labelled sequences: events of a user stand for the spans of a document.

The text of a user's document is the texts of the events in order, parted by a
space, so spans have true offsets and evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V
from spanforge.operators import payload as Y
from spanforge.operators import relations as R
from spanforge.operators import segment as S
from spanforge.plans import flow, matching
from spanforge.sources.staging import staged
from spanforge.sources.tables import table

#: Labels of event types: with starred headings, and with markers.
STARRED = {"signup": V.ORG_STAR, "view": V.ORG, "click": V.TITLE, "purchase": V.PARAGRAPH, "error": V.BODY}
MARKED = {"signup": V.MARKER, "view": V.ORG, "click": V.TITLE, "purchase": V.PARAGRAPH, "error": V.BODY}
SPLIT = {"signup": V.SUMMARY, "view": V.ORG, "click": V.TITLE, "purchase": V.PARAGRAPH, "error": V.BODY}
#: No starred headings: every event but each third signup is as in STARRED.
FLAT = {"signup": V.JUNK, "view": V.ORG, "click": V.TITLE, "purchase": V.PARAGRAPH, "error": V.BODY}


def spans(spark: SparkSession, sf_dir: str, labels: dict[str, str]) -> DataFrame:
    """doc_id, seq, label, text, start, end."""
    label = F.lit(None).cast("string")
    for kind, name in labels.items():
        label = F.when(F.col("event_type") == kind, name).otherwise(label)
    w = W.partitionBy("doc_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), "ts", "event_id", label.alias("label"), F.concat("event_type", F.substring(F.lit("abcdefg"), F.lit(1), (F.col("event_id") % 4).cast("int"))).alias("text"))
    start = F.coalesce(F.sum(F.length("text") + 1).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.select("doc_id", F.row_number().over(w).alias("seq"), "label", "text", start.alias("start")).withColumn("end", F.col("start") + F.length("text"))


def texts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("seq", "text")))["text"], " ").alias("text"))


def _flat(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "ord", "paragraph_id", "kind", F.col("head.seq").alias("head_seq"), F.col("tail.seq").alias("tail_seq"), F.col("head.text").alias("head_text"), F.col("tail.text").alias("tail_text"))


def paragraph_ids_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.paragraphs_by_star(spans(spark, sf_dir, STARRED)).select("doc_id", "seq", "label", "paragraph_id")


def paragraph_ids_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.paragraphs_by_title(spans(spark, sf_dir, MARKED)).select("doc_id", F.col("at").alias("at_seq"), "part", "paragraph_id", "seq", "label")


def relations_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir, FLAT)
    found = R.with_evidence(R.relations_by_star(rows), texts(rows))
    return _flat(found).join(found.select("doc_id", "ord", F.md5("evidence_text").alias("evidence_md5")), ["doc_id", "ord"])


def relations_star_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(R.relations_by_star(spans(spark, sf_dir, STARRED)))


def relations_mode_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(R.relations_by_title(spans(spark, sf_dir, MARKED)))


def toc_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = Y.items_by_star(R.relations_by_star(spans(spark, sf_dir, FLAT)))
    return items.where("org is not null").select("doc_id", "paragraph_id", F.col("org.text").alias("org"), F.array_join("docs.text", "|").alias("docs"))


def toc_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = Y.items_by_star(R.relations_by_star(spans(spark, sf_dir, STARRED)))
    subs = items.where("top_org is not null").select("doc_id", "paragraph_id", F.col("top_org.text").alias("top_org"), F.posexplode("sub_orgs").alias("sub", "s"))
    return subs.select("doc_id", "paragraph_id", "top_org", "sub", F.col("s.org.text").alias("org"), F.array_join("s.docs.text", "|").alias("docs"))


def toc_org_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.title_orgs(R.relations_by_title(spans(spark, sf_dir, MARKED)))


def toc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = Y.items_by_title(R.relations_by_title(spans(spark, sf_dir, MARKED)))
    return items.select("doc_id", "paragraph_id", F.array_join(F.col("org_ids").cast("array<string>"), "|").alias("org_ids"), F.col("doc_name.text").alias("doc_name"), F.array_join("children.child", "|").alias("children"))


def split_on_repeat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir, SPLIT)
    return S.split_at_repeat(rows, rows.groupBy("doc_id").agg(F.max("end").alias("n_chars")))


def anchor_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir, STARRED)
    anchors = rows.where(F.col("label").isin(R.ORGS)).select("doc_id", "seq", "start")
    return S.slices(anchors, rows.groupBy("doc_id").agg(F.max("end").alias("n_chars")))


#: Keys wanted by coalesced_anchors: single names and merges of two and three.
WANTED = ["VIEWA", "VIEWVIEW", "VIEWABVIEW", "VIEWVIEWABC", "VIEWVIEWVIEWAB", "SIGNUPVIEW", "SIGNUP"]


def coalesced_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir, STARRED)
    wanted = rows.select("doc_id").distinct().withColumn("org_key", F.explode(F.array(*(F.lit(k) for k in WANTED))))
    return S.coalesced_anchors(rows, texts(rows), wanted).drop("text")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A user's first half of events tells the contents, the second half is the body, with offsets from 0."""
    rows = spans(spark, sf_dir, FLAT).withColumn("half", (F.col("seq") > F.count(F.lit(1)).over(W.partitionBy("doc_id")) / 2).cast("int"))
    first = rows.where("half = 0").drop("half")
    body = rows.where("half = 1").withColumn("base", F.min("start").over(W.partitionBy("doc_id")))
    return first, body.select("doc_id", "seq", "label", "text", (F.col("start") - F.col("base")).alias("start"), (F.col("end") - F.col("base")).alias("end"))


def block_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, body = _halves(spark, sf_dir)
    items = Y.items_by_star(R.relations_by_star(first)).where("org is not null").select("doc_id", F.col("paragraph_id").alias("item"), F.col("org.text").alias("org_text"), F.col("docs.text").alias("docs"))
    body = staged(body, "body")
    out = S.segment_flat(body, staged(texts(body), "texts"), staged(items, "items"))
    return out.select("doc_id", "item", "org_text", "status", "start", "stop", "n_docs", "n_missed", "n_slices", _shown("slices").alias("slices"))


def _shown(c: str) -> Column:
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["doc_name"], s["start"].cast("string"), s["stop"].cast("string"))), "|")


def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summary(block_status(spark, sf_dir))


def _nested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Spans of users' whole sequences, their texts and items, and starred items found again in that sequence."""
    rows = staged(spans(spark, sf_dir, STARRED), "spans")  # read by each of the branches below
    items = staged(Y.items_by_star(R.relations_by_star(rows)), "items")
    subs = items.where("top_org is not null").select("doc_id", F.col("paragraph_id").alias("item"), F.col("top_org.text").alias("top_text"), F.posexplode("sub_orgs").alias("sub", "s"))
    named = staged(subs.select("doc_id", "item", "top_text", "sub", F.col("s.org.text").alias("sub_text"), F.col("s.docs.text").alias("docs")), "subs")
    bodies = staged(texts(rows), "texts")
    return rows, bodies, items, S.segment_nested(rows, bodies, named)


def nested_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starred items of a user's whole sequence, found again in that sequence, with their slices."""
    return _nested(spark, sf_dir)[-1].drop("docs").withColumn("slices", _shown("slices"))


def nested_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summary(_nested(spark, sf_dir)[-1])


def loss_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules for starred contents drop, by user and reason."""
    rows, _, items, nested = _nested(spark, sf_dir)
    lost = S.losses_starred(rows, items, staged(nested, "nested"))
    return lost.groupBy("doc_id", "reason").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


def nested_slice_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every slice of nested segments."""
    _, bodies, _, nested = _nested(spark, sf_dir)
    made = flow.slice_texts(nested, bodies)
    return made.select("doc_id", "item", "sub", "nth", "doc_name", F.md5("text").alias("text_md5"))


def _titled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = staged(spans(spark, sf_dir, MARKED), "spans")
    found = staged(R.relations_by_title(rows), "relations")
    bodies = staged(texts(rows), "texts")
    orgs = staged(Y.title_orgs(found), "orgs")
    items = staged(Y.items_by_title(found).select("doc_id", F.col("paragraph_id").alias("item"), "org_ids", F.col("doc_name.text").alias("title")), "items")
    windows = staged(S.kept_windows(rows, orgs, bodies.select("doc_id", F.length("text").cast("bigint").alias("n_chars"))), "windows")
    located = staged(S.located_titles(rows, windows, bodies.select("doc_id", F.length("text").cast("bigint").alias("n_chars")), items), "located")
    return {"bodies": bodies, "orgs": orgs, "items": items, "windows": windows, "located": located, "segments": S.segment_titles(rows, bodies, orgs, items, located=located, windows=windows)}


def title_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titled(spark, sf_dir)["segments"].withColumn("confidence", F.round("confidence", 6))


def title_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _titled(spark, sf_dir)
    return S.losses_titled(made["items"], made["located"])


def title_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of title-driven sequences, with the sub-slices of their segments."""
    made = _titled(spark, sf_dir)
    segments = staged(made["segments"], "segments")
    shown = F.substring("_text", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    parts = segments.where("start is not null").join(made["bodies"].select("doc_id", F.col("text").alias("_text")), "doc_id").select("doc_id", F.concat_ws(".", "org_id", "item").alias("segment"), shown.alias("text")).where(F.trim("text") != "")
    parts = staged(parts, "segment-texts")
    none = parts.select("doc_id", "segment", F.lit(0).alias("ord"), F.lit("").alias("title")).limit(0)
    return S.summary_titles(segments, made["orgs"], made["windows"], S.sub_slices(parts, none), made["located"])


def ordered_doc_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of a user's first half looked for in order among those of the second half."""
    first, body = _halves(spark, sf_dir)
    wanted = first.where(F.col("label") == V.TITLE).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text")))["text"].alias("wanted"))
    heads = body.where(F.col("label") == V.TITLE).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text")))["text"].alias("heads"))
    return wanted.join(heads, "doc_id").select("doc_id", F.array_join(S.ordered_match(F.col("heads"), F.col("wanted")).cast("array<string>"), ",").alias("found"))


def header_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.header_blocks(spans(spark, sf_dir, FLAT)).withColumn("headers", F.array_join("headers", "|"))


def export_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.compact(R.relations_by_title(spans(spark, sf_dir, MARKED)))


def export_by_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Y.by_head(R.relations_by_star(spans(spark, sf_dir, STARRED)))
    kinds = F.array_join(F.transform("relations", lambda r: F.concat(r["kind"], F.lit("="), F.array_join(r["tails"]["text"], "|"))), ";")
    return rows.select("doc_id", "paragraph_id", F.col("head.text").alias("head"), F.col("head.label").alias("head_label"), kinds.alias("relations"))


def export_grouped_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.grouped_json(R.relations_by_star(spans(spark, sf_dir, STARRED))).select("doc_id", F.md5("json").alias("json_md5"))


def window_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each title's window among the organisation windows of its user."""
    rows = spans(spark, sf_dir, FLAT)
    ends = rows.groupBy("doc_id").agg(F.max("end").alias("n_chars"))
    anchors = S.slices(rows.where(F.col("label") == V.ORG).select("doc_id", "start"), ends)
    windows = anchors.withColumn("idx", F.row_number().over(W.partitionBy("doc_id").orderBy("start")) - 1)
    return S.bounded_by_window(rows.where(F.col("label") == V.TITLE).select("doc_id", "start"), windows, ends)


QUERIES = {
    f.__name__: f
    for f in (paragraph_ids_star, paragraph_ids_title, relations_pairs, relations_star_blocks, relations_mode_ab, toc_flat, toc_star, toc_org_ids, toc_items, split_on_repeat_key, anchor_slices, coalesced_anchors, block_status, summary_counts, nested_segments, nested_summary, nested_slice_texts, loss_counts, title_segments, title_summary, title_losses, ordered_doc_match, header_blocks, export_csv_rows, export_by_head, export_grouped_json, window_locate)
}

# --- The same in SQL ---------------------------------------------------------


def _spans(labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"""ev AS (
    SELECT *, start + length(text) AS "end" FROM (
        SELECT doc_id, row_number() OVER w AS seq, label, text, coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM (SELECT user_id AS doc_id, ts, event_id, CASE event_type {cases} END AS label, event_type || left('abcdefg', (event_id % 4)::INTEGER) AS text FROM events)
        WINDOW w AS (PARTITION BY doc_id ORDER BY ts, event_id))
)"""


_NUMBERED = """rel AS (
    SELECT r.doc_id, row_number() OVER (PARTITION BY r.doc_id ORDER BY pid NULLS FIRST, phase, hs, ts)::INTEGER AS ord, pid AS paragraph_id, kind, h.seq::INTEGER AS head_seq, t.seq::INTEGER AS tail_seq,
           h.text AS head_text, t.text AS tail_text, h.label AS head_label, t.label AS tail_label, h."end" AS head_end, t.start AS tail_start
    FROM rel0 r JOIN ev h ON h.doc_id = r.doc_id AND h.seq = r.hs JOIN ev t ON t.doc_id = r.doc_id AND t.seq = r.ts
)"""


def _star(labels: dict[str, str], head: str | None = None) -> str:
    return f"""{head or _spans(labels)}, para AS (
    SELECT *, nullif(sum(opens) OVER (PARTITION BY doc_id ORDER BY seq) - 1, -1)::INTEGER AS pid FROM (
        SELECT *, (label = '{V.ORG_STAR}' OR (label = '{V.ORG}' AND NOT EXISTS (SELECT 1 FROM ev s WHERE s.doc_id = e.doc_id AND s.label = '{V.ORG_STAR}' AND s.seq < e.seq)))::INTEGER AS opens FROM ev e
        WHERE label IN ('{V.ORG}', '{V.ORG_STAR}', '{V.TITLE}', '{V.BODY}', '{V.PARAGRAPH}'))
), block AS (
    SELECT *, sum((label = '{V.ORG}')::INTEGER) OVER (PARTITION BY doc_id, pid ORDER BY seq) AS blk, bool_or(label = '{V.ORG_STAR}') OVER (PARTITION BY doc_id, pid) AS starred FROM para
), rel0 AS (
    SELECT o.doc_id, o.pid, 0 AS phase, '{V.STAR_ORG}' AS kind, s.seq AS hs, o.seq AS ts FROM block o JOIN block s ON s.doc_id = o.doc_id AND s.pid = o.pid AND s.label = '{V.ORG_STAR}' WHERE o.label = '{V.ORG}'
    UNION ALL SELECT t.doc_id, t.pid, 1, '{V.ORG_TITLE}', o.seq, t.seq FROM block t JOIN block o ON o.doc_id = t.doc_id AND o.pid = t.pid AND o.blk = t.blk AND o.label = '{V.ORG}' AND o.seq < t.seq WHERE t.label = '{V.TITLE}'
    UNION ALL SELECT t.doc_id, t.pid, 1, '{V.TITLE_BODY}', t.seq, min(b.seq) FROM block t JOIN block b ON b.doc_id = t.doc_id AND b.pid IS NOT DISTINCT FROM t.pid AND b.blk = t.blk AND b.seq > t.seq AND b.label IN ('{V.BODY}', '{V.PARAGRAPH}')
        WHERE t.label = '{V.TITLE}' AND (NOT t.starred OR t.blk > 0) GROUP BY t.doc_id, t.pid, t.seq, b.label
), {_NUMBERED}"""



_TITLED = f"""{_spans(MARKED)}, numbered AS (
    SELECT e.*, (SELECT count(*) FROM ev t WHERE t.doc_id = e.doc_id AND t.label = '{V.TITLE}' AND t.seq <= e.seq) AS nt,
           (SELECT min(seq) FROM ev t WHERE t.doc_id = e.doc_id AND t.label = '{V.TITLE}') AS ft, (SELECT min(seq) FROM ev t WHERE t.doc_id = e.doc_id AND t.label = '{V.ORG}') AS fo,
           (SELECT max(seq) FROM ev o WHERE o.doc_id = e.doc_id AND o.label = '{V.ORG}' AND o.seq <= e.seq) AS under, (SELECT max(seq) FROM ev m WHERE m.doc_id = e.doc_id AND m.label = '{V.MARKER}' AND m.seq <= e.seq) AS mark
    FROM ev e
), placed AS (
    SELECT *, nullif(nt + (fo IS NOT NULL AND fo <= seq AND (ft IS NULL OR fo < ft))::INTEGER - 1, -1)::INTEGER AS pid FROM numbered
), collected AS (
    SELECT doc_id, seq AS at_seq, 2 AS part, pid, seq, label FROM placed WHERE label <> '{V.MARKER}'
    UNION ALL SELECT doc_id, seq, 0, pid, under, '{V.ORG}' FROM placed WHERE label = '{V.TITLE}' AND under IS NOT NULL
    UNION ALL SELECT doc_id, seq, 1, pid, mark, '{V.MARKER}' FROM placed WHERE label = '{V.TITLE}' AND mark > under
), kindly AS (
    SELECT *, bool_or(label = '{V.MARKER}') OVER p AS mode_b, bool_or(label = '{V.TITLE}') OVER p AS titled, min(CASE WHEN label = '{V.TITLE}' THEN seq END) OVER p AS title_seq,
           first_value(CASE WHEN label = '{V.ORG}' THEN seq END IGNORE NULLS) OVER (PARTITION BY doc_id, pid ORDER BY at_seq, part ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS org_seq,
           CASE WHEN label IN ('{V.BODY}', '{V.PARAGRAPH}') THEN row_number() OVER (PARTITION BY doc_id, pid, label IN ('{V.BODY}', '{V.PARAGRAPH}') ORDER BY at_seq) END AS nth
    FROM collected WINDOW p AS (PARTITION BY doc_id, pid)
), rel0 AS (
    SELECT doc_id, pid, 0 AS phase, '{V.ORG_TITLE}' AS kind, org_seq AS hs, seq AS ts FROM kindly WHERE label = '{V.TITLE}' AND org_seq < seq
    UNION ALL SELECT doc_id, pid, 1, CASE label WHEN '{V.BODY}' THEN '{V.TITLE_BODY}' ELSE '{V.TITLE_PARAGRAPH}' END, title_seq, seq FROM kindly WHERE nth IS NOT NULL AND title_seq IS NOT NULL AND (mode_b OR nth = 1)
    UNION ALL SELECT doc_id, pid, 0, CASE label WHEN '{V.BODY}' THEN '{V.ORG_BODY}' ELSE '{V.ORG_PARAGRAPH}' END, org_seq, seq FROM kindly WHERE nth IS NOT NULL AND NOT titled AND org_seq IS NOT NULL
), {_NUMBERED}"""

_REL = "doc_id, ord, paragraph_id, kind, head_seq, tail_seq, head_text, tail_text"
_ORGS = f"'{V.ORG}', '{V.ORG_STAR}'"
_IDS = f"""ids AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY min(ord))::INTEGER AS id, head_text AS text, head_label AS label FROM rel WHERE head_label IN ({_ORGS}) AND kind NOT IN ('{V.STAR_ORG}') GROUP BY doc_id, head_text, head_label
)"""
_LETTERS = "regexp_replace(lower(text), '[^\\p{L}]', '', 'g')"
_KEY = "upper(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g'))"
_WANTED = ", ".join(f"'{k}'" for k in WANTED)
_HALVES = f"""{_spans(FLAT)}, halves AS (SELECT *, seq > count(*) OVER (PARTITION BY doc_id) / 2 AS second FROM ev),
body AS (SELECT doc_id, seq, label, text, start - min(start) OVER (PARTITION BY doc_id) AS start, "end" - min(start) OVER (PARTITION BY doc_id) AS "end" FROM halves WHERE second)"""
_MATCHED = f"""{_HALVES}, w AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS k FROM halves WHERE NOT second AND label = '{V.TITLE}'),
h AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY seq) - 1 AS i FROM body WHERE label = '{V.TITLE}'),
walk(doc_id, k, nxt, hit) AS (
    SELECT doc_id, 0::BIGINT, 0::BIGINT, NULL::BIGINT FROM (SELECT DISTINCT doc_id FROM w SEMI JOIN h USING (doc_id))
    UNION ALL
    SELECT p.doc_id, p.k + 1, coalesce(min(h.i) + 1, 1000000000), coalesce(min(h.i), -1) FROM walk p JOIN w ON w.doc_id = p.doc_id AND w.k = p.k + 1 LEFT JOIN h ON h.doc_id = p.doc_id AND h.text = w.text AND h.i >= p.nxt
    GROUP BY p.doc_id, p.k
)"""


def _anchors(name: str, heads: str, wanted: str, ends: str) -> str:
    """CTEs up to name (id, start, stop, org_key, text): merges of neighbours among heads (id, seq, text, start, "end") whose key is in wanted (id, k), each up to the next or the end (id, n)."""
    key3, key2, key1 = (_KEY.format(x) for x in ("o.text || t1 || t2", "o.text || t1", "o.text"))
    return f"""{name}_keys AS (SELECT id, list(DISTINCT k) AS ks FROM {wanted} WHERE k <> '' GROUP BY id),
{name}_orgs AS (SELECT *, row_number() OVER w AS i, lead(text) OVER w AS t1, lead(text, 2) OVER w AS t2, lead(seq) OVER w = seq + 1 AS g1, lead(seq, 2) OVER w = seq + 2 AS g2, lead("end") OVER w AS e1, lead("end", 2) OVER w AS e2
    FROM {heads} WINDOW w AS (PARTITION BY id ORDER BY start)),
{name}_wide AS (SELECT o.*, CASE WHEN g1 AND g2 AND list_contains(ks, {key3}) THEN 3 WHEN g1 AND list_contains(ks, {key2}) THEN 2 WHEN list_contains(ks, {key1}) THEN 1 ELSE 0 END AS width FROM {name}_orgs o JOIN {name}_keys USING (id)),
{name}_walk(id, i) AS (SELECT DISTINCT id, 1::BIGINT FROM {name}_wide UNION ALL SELECT p.id, p.i + greatest(width, 1) FROM {name}_walk p JOIN {name}_wide USING (id, i)),
{name}_found AS (SELECT id, start, CASE width WHEN 3 THEN text || ' ' || t1 || ' ' || t2 WHEN 2 THEN text || ' ' || t1 ELSE text END AS text FROM {name}_walk JOIN {name}_wide USING (id, i) WHERE width > 0),
{name} AS (SELECT id, start, coalesce(lead(start) OVER (PARTITION BY id ORDER BY start), n) AS stop, {_KEY.format("text")} AS org_key, text FROM {name}_found JOIN {ends} USING (id))"""


_FIRST_HALF = f"""{_spans(FLAT).replace("ev AS", "ev_all AS", 1)}, halves AS (SELECT *, seq > count(*) OVER (PARTITION BY doc_id) / 2 AS second FROM ev_all),
ev AS (SELECT doc_id, seq, label, text, start, "end" FROM halves WHERE NOT second),
body AS (SELECT doc_id, seq, label, text, start - min(start) OVER (PARTITION BY doc_id) AS start, "end" - min(start) OVER (PARTITION BY doc_id) AS "end" FROM halves WHERE second)"""
_BLOCKS = f"""WITH RECURSIVE {_star(FLAT, _FIRST_HALF)},
items AS (SELECT doc_id, paragraph_id AS item, head_text AS org_text, {_KEY.format("head_text")} AS org_key, list(tail_text ORDER BY ord) AS docs FROM rel WHERE kind = '{V.ORG_TITLE}' GROUP BY 1, 2, 3),
orgs_in AS (SELECT doc_id AS id, seq, text, start, "end" FROM body WHERE label = '{V.ORG}'), wanted_in AS (SELECT doc_id AS id, org_key AS k FROM items), ends_in AS (SELECT doc_id AS id, max("end") AS n FROM body GROUP BY 1),
{_anchors("anchors", "orgs_in", "wanted_in", "ends_in")},
firsts AS (SELECT id AS doc_id, org_key, min(start) AS start, arg_min(stop, start) AS stop FROM anchors GROUP BY 1, 2),
blocks AS (SELECT i.doc_id, item, org_text, docs, start, stop FROM items i LEFT JOIN firsts f ON f.doc_id = i.doc_id AND f.org_key = i.org_key),
heads AS (SELECT b.doc_id, item, h.start, h.text, row_number() OVER (PARTITION BY b.doc_id, item ORDER BY h.start) - 1 AS i, coalesce(lead(h.start) OVER (PARTITION BY b.doc_id, item ORDER BY h.start), b.stop) AS stop
    FROM blocks b JOIN body h ON h.doc_id = b.doc_id AND h.label = '{V.TITLE}' AND h.start >= b.start AND h.start < b.stop),
asked AS (SELECT doc_id, item, unnest(docs) AS text, unnest(range(1, len(docs) + 1)) AS k FROM blocks WHERE start IS NOT NULL),
walk(doc_id, item, k, nxt, hit, text) AS (
    SELECT DISTINCT doc_id, item, 0::BIGINT, 0::BIGINT, -1::BIGINT, NULL::VARCHAR FROM asked
    UNION ALL
    SELECT p.doc_id, p.item, a.k, coalesce(min(h.i) + 1, 1000000000), coalesce(min(h.i), -1), a.text FROM walk p JOIN asked a ON a.doc_id = p.doc_id AND a.item = p.item AND a.k = p.k + 1
    LEFT JOIN heads h ON h.doc_id = p.doc_id AND h.item = p.item AND h.text = a.text AND h.i >= p.nxt GROUP BY p.doc_id, p.item, a.k, a.text
), by_name AS (SELECT w.doc_id, w.item, count(*) AS n, string_agg(concat_ws(':', w.text, h.start::VARCHAR, h.stop::VARCHAR), '|' ORDER BY w.k) AS s FROM walk w JOIN heads h ON h.doc_id = w.doc_id AND h.item = w.item AND h.i = w.hit WHERE w.k > 0 GROUP BY 1, 2),
every AS (SELECT doc_id, item, count(*) AS n, string_agg(concat_ws(':', text, start::VARCHAR, stop::VARCHAR), '|' ORDER BY start) AS s FROM heads GROUP BY 1, 2),
cut AS (SELECT b.*, coalesce(e.n, 0) = 0 AND len(docs) = 1 AS alone, n.n AS n_named, coalesce(n.n, e.n, 0) AS n_cut, coalesce(n.s, e.s, '') AS s FROM blocks b LEFT JOIN by_name n USING (doc_id, item) LEFT JOIN every e USING (doc_id, item)),
status AS (SELECT doc_id, item, org_text, CASE WHEN start IS NULL THEN 'org_missing' WHEN alone OR len(docs) = 0 THEN 'ok' WHEN n_cut = 0 THEN 'doc_missing' WHEN coalesce(n_named, 0) < len(docs) THEN 'partial' ELSE 'ok' END AS status,
    start, stop, len(docs)::INTEGER AS n_docs, (CASE WHEN start IS NULL THEN len(docs) WHEN alone THEN 0 ELSE len(docs) - coalesce(n_named, 0) END)::INTEGER AS n_missed, (CASE WHEN start IS NULL THEN 0 WHEN alone THEN 1 ELSE n_cut END)::INTEGER AS n_slices,
    CASE WHEN start IS NULL THEN NULL WHEN alone THEN concat_ws(':', docs[1], start::VARCHAR, stop::VARCHAR) ELSE s END AS slices FROM cut)"""
_NESTED = f"""WITH RECURSIVE {_star(STARRED)}, subs0 AS (
    SELECT doc_id, paragraph_id AS item, head_text AS top_text, tail_text AS sub_text, min(ord) AS o FROM rel WHERE kind = '{V.STAR_ORG}' GROUP BY 1, 2, 3, 4),
subs AS (SELECT s.doc_id, item, top_text, sub_text, {_KEY.format("sub_text")} AS org_key, doc_id || '/' || item AS id, (row_number() OVER (PARTITION BY doc_id, item ORDER BY o) - 1)::INTEGER AS sub,
    coalesce((SELECT list(tail_text ORDER BY ord) FROM rel r WHERE r.kind = '{V.ORG_TITLE}' AND r.doc_id = s.doc_id AND r.paragraph_id = s.item AND r.head_text = s.sub_text), []) AS docs FROM subs0 s),
all_orgs AS (SELECT doc_id AS id, seq, text, start, "end" FROM ev WHERE label IN ({_ORGS})), all_ends AS (SELECT doc_id AS id, max("end") AS n FROM ev GROUP BY 1), all_tops AS (SELECT doc_id AS id, {_KEY.format("top_text")} AS k FROM subs),
{_anchors("tops", "all_orgs", "all_tops", "all_ends")},
first_tops AS (SELECT id AS doc_id, org_key, min(start) AS start, arg_min(stop, start) AS stop FROM tops GROUP BY 1, 2),
ranges AS (SELECT DISTINCT s.id, s.doc_id, f.start, f.stop FROM subs s JOIN first_tops f ON f.doc_id = s.doc_id AND f.org_key = {_KEY.format("s.top_text")}),
in_orgs AS (SELECT r.id, e.seq, e.text, e.start, e."end" FROM ranges r JOIN ev e ON e.doc_id = r.doc_id AND e.label IN ({_ORGS}) AND e.start >= r.start AND e.start < r.stop),
in_wanted AS (SELECT id, org_key AS k FROM subs SEMI JOIN ranges USING (id)), in_ends AS (SELECT id, stop AS n FROM ranges),
{_anchors("places", "in_orgs", "in_wanted", "in_ends")},
nth AS (SELECT *, row_number() OVER (PARTITION BY id, org_key ORDER BY start) AS k FROM places),
cut AS (SELECT s.id, s.sub, count(*) AS n, min(p.start) AS start, max(p.stop) AS stop, string_agg(concat_ws(':', CASE WHEN k <= len(docs) THEN docs[k] ELSE p.text END, p.start::VARCHAR, p.stop::VARCHAR), '|' ORDER BY k) AS slices
    FROM subs s JOIN nth p ON p.id = s.id AND p.org_key = s.org_key GROUP BY 1, 2)
SELECT s.doc_id, s.item, s.sub, sub_text, CASE WHEN n IS NULL THEN 'org_missing' WHEN n = len(docs) THEN 'ok' ELSE 'partial' END AS status, c.start, c.stop, len(docs)::INTEGER AS n_docs, greatest(len(docs) - coalesce(n, 0), 0)::INTEGER AS n_missed, coalesce(n, 0)::INTEGER AS n_slices, coalesce(slices, '') AS slices, r.id IS NOT NULL AS top_found
FROM subs s LEFT JOIN cut c ON c.id = s.id AND c.sub = s.sub LEFT JOIN ranges r ON r.id = s.id"""
_TITLE_SEGMENTS = f"""WITH RECURSIVE {_TITLED}, {_IDS}, names AS (
    SELECT doc_id, paragraph_id AS item, coalesce(min_by(CASE WHEN kind = '{V.ORG_TITLE}' THEN tail_text END, CASE WHEN kind = '{V.ORG_TITLE}' THEN ord END), min_by(CASE WHEN head_label = '{V.TITLE}' THEN head_text END, CASE WHEN head_label = '{V.TITLE}' THEN ord END)) AS title FROM rel GROUP BY 1, 2),
n AS (SELECT doc_id, max("end") AS n_chars FROM ev GROUP BY 1),
kept AS (SELECT e.doc_id, e.start, e.text AS name FROM ev e WHERE label = '{V.ORG}' AND EXISTS (SELECT 1 FROM ids WHERE ids.doc_id = e.doc_id AND (contains(e.text, ids.text) OR contains(ids.text, e.text)))),
wins AS (SELECT doc_id, row_number() OVER w - 1 AS idx, name, start AS a, coalesce(lead(start) OVER w, n_chars) AS b FROM kept JOIN n USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY start)
    UNION ALL SELECT doc_id, 0, '(global)', 0, n_chars FROM n ANTI JOIN kept USING (doc_id)),
best AS (SELECT doc_id, id, a, b FROM (SELECT i.doc_id, i.id, w.a, w.b, row_number() OVER (PARTITION BY i.doc_id, i.id ORDER BY (w.name = i.text) DESC, idx) AS r FROM ids i JOIN wins w USING (doc_id)) WHERE r = 1),
wanted AS (SELECT doc_id, item, {matching.KEYS} FROM names WHERE title IS NOT NULL), titles AS (SELECT doc_id, start, "end", {matching.KEYS} FROM (SELECT *, text AS title FROM ev WHERE label = '{V.TITLE}')),
{matching.passes()}, {matching.CONTAINED},
located AS (SELECT m.doc_id, m.item, t."end" AS start, CASE WHEN idx IS NULL THEN n_chars ELSE coalesce(lead(m.start) OVER (PARTITION BY m.doc_id, idx ORDER BY m.start), b) END AS stop, confidence
    FROM matched m JOIN titles t ON t.doc_id = m.doc_id AND t.start = m.start JOIN n ON n.doc_id = m.doc_id LEFT JOIN wins w ON w.doc_id = m.doc_id AND m.start >= a AND m.start < b),
members AS (SELECT DISTINCT r.doc_id, paragraph_id AS item, id FROM rel r JOIN ids i ON i.doc_id = r.doc_id AND i.text = r.head_text AND i.label = r.head_label)
SELECT doc_id, item, m.id AS org_id, coalesce(title, '(Preambulo)') AS title, CASE WHEN title IS NULL THEN 'doc_children_segment' WHEN l.start IS NULL THEN 'doc_type_unanchored' ELSE 'doc_type_segment' END AS status,
    CASE WHEN title IS NULL THEN 0.5 ELSE coalesce(confidence, 0.0) END::DOUBLE AS confidence, CASE WHEN title IS NULL THEN b.a ELSE l.start END AS start, CASE WHEN title IS NULL THEN b.b ELSE greatest(l.start, l.stop) END AS stop
FROM names JOIN members m USING (doc_id, item) JOIN best b ON b.doc_id = m.doc_id AND b.id = m.id LEFT JOIN located l USING (doc_id, item)"""

_NESTED_CTES, _NESTED_ROWS = _NESTED.rsplit("\n", 2)[0], "\n".join(_NESTED.rsplit("\n", 2)[1:])
_TITLE_CTES, _TITLE_ROWS = _TITLE_SEGMENTS.rsplit("\n", 3)[0], "\n".join(_TITLE_SEGMENTS.rsplit("\n", 3)[1:])
_STATUSES = ", ".join(f"count_if(status = '{a}')::BIGINT AS {b}" for a, b in (("ok", "org_ok"), ("partial", "org_partial"), ("doc_missing", "org_doc_missing"), ("org_missing", "org_missing")))
_COUNTED = "sum(n_docs)::BIGINT AS docs_expected, sum(n_docs - n_missed)::BIGINT AS docs_matched, sum(n_slices)::BIGINT AS docs_matched_ref"

ORACLES = {
    "block_status": f"{_BLOCKS} SELECT * FROM status",
    "summary_counts": f"""{_BLOCKS} SELECT doc_id, count(*) AS orgs_total, {_STATUSES},
        {_COUNTED}, count_if(status = 'ok')::BIGINT AS org_ok_ref, count_if(status = 'partial')::BIGINT AS org_partial_ref, sum(n_docs)::BIGINT AS docs_expected_ref FROM status GROUP BY doc_id""",
    "nested_summary": f"""{_NESTED_CTES}, nested AS ({_NESTED_ROWS}) SELECT doc_id, count(*) AS orgs_total, {_STATUSES},
        {_COUNTED}, 0::BIGINT AS org_ok_ref, 0::BIGINT AS org_partial_ref, sum(CASE WHEN top_found THEN n_docs ELSE 0 END)::BIGINT AS docs_expected_ref FROM nested GROUP BY doc_id""",
    "loss_counts": f"""{_NESTED_CTES}, nested AS ({_NESTED_ROWS}), lost AS (
        SELECT doc_id, 'before_org' AS reason, text AS name FROM block WHERE starred AND blk = 0 AND label IN ('{V.TITLE}', '{V.BODY}', '{V.PARAGRAPH}')
        UNION ALL SELECT doc_id, 'beside_starred', tail_text FROM rel WHERE kind = '{V.ORG_TITLE}' AND (doc_id, paragraph_id) NOT IN (SELECT (doc_id, item) FROM subs) AND doc_id IN (SELECT doc_id FROM subs)
        UNION ALL SELECT doc_id, CASE WHEN NOT top_found THEN 'top_missing' WHEN status = 'org_missing' THEN 'org_missing' ELSE 'unmatched' END, unnest(docs[n_docs - n_missed + 1:n_docs]) FROM nested JOIN (SELECT doc_id, item, sub, docs FROM subs) USING (doc_id, item, sub) WHERE n_missed > 0)
        SELECT doc_id, reason, count(*) AS n, array_to_string(list_sort(list(DISTINCT name)), '|') AS names FROM lost GROUP BY 1, 2""",
    "nested_slice_texts": f"""{_NESTED_CTES}, body_text AS (SELECT doc_id, string_agg(text, ' ' ORDER BY seq) AS t FROM ev GROUP BY 1)
        SELECT s.doc_id, s.item, s.sub, k::INTEGER AS nth, CASE WHEN k <= len(docs) THEN docs[k] ELSE p.text END AS doc_name, md5(t[p.start + 1:p.stop]) AS text_md5 FROM subs s JOIN nth p ON p.id = s.id AND p.org_key = s.org_key JOIN body_text b ON b.doc_id = s.doc_id""",
    "title_summary": f"""{_TITLE_CTES}, seg AS ({_TITLE_ROWS}), body_text AS (SELECT doc_id, string_agg(text, ' ' ORDER BY seq) AS t FROM ev GROUP BY 1)
        SELECT doc_id, coalesce(orgs_in_payload, 0) AS orgs_in_payload, coalesce(org_windows_found, 0) AS org_windows_found, coalesce(doc_type_headers_matched, 0) AS doc_type_headers_matched, coalesce(doc_type_segments, 0)::BIGINT AS doc_type_segments, coalesce(segments_with_subdivisions, 0) AS segments_with_subdivisions, true AS segment_reparsed
        FROM (SELECT doc_id, count(*) AS orgs_in_payload FROM ids GROUP BY 1) FULL JOIN (SELECT doc_id, count(*) AS org_windows_found FROM wins GROUP BY 1) USING (doc_id) FULL JOIN (SELECT doc_id, count(*) AS doc_type_headers_matched FROM located GROUP BY 1) USING (doc_id)
        FULL JOIN (SELECT doc_id, count_if(status <> 'doc_type_unanchored') AS doc_type_segments FROM seg GROUP BY 1) USING (doc_id) FULL JOIN (SELECT doc_id, count(*) AS segments_with_subdivisions FROM seg JOIN body_text USING (doc_id) WHERE start IS NOT NULL AND trim(t[start + 1:stop]) <> '' GROUP BY 1) USING (doc_id)""",
    "title_losses": f"""{_TITLE_CTES} SELECT doc_id, 'no_org' AS reason, item, title AS name FROM names ANTI JOIN members USING (doc_id, item)
        UNION ALL SELECT doc_id, 'unanchored', item, title FROM names SEMI JOIN members USING (doc_id, item) ANTI JOIN located USING (doc_id, item) WHERE title IS NOT NULL""",
    "nested_segments": _NESTED,
    "title_segments": _TITLE_SEGMENTS,
    "paragraph_ids_star": f"WITH {_star(STARRED)} SELECT doc_id, seq::INTEGER AS seq, label, pid AS paragraph_id FROM para",
    "paragraph_ids_title": f"WITH {_TITLED} SELECT doc_id, at_seq::INTEGER AS at_seq, part, pid AS paragraph_id, seq::INTEGER AS seq, label FROM collected",
    "relations_pairs": f"""WITH RECURSIVE {_star(FLAT)}, texts AS (SELECT doc_id, string_agg(text, ' ' ORDER BY seq) AS t FROM ev GROUP BY doc_id)
        SELECT {_REL}, md5(trim(substr(t, head_end + 1, greatest(tail_start - head_end, 0)))) AS evidence_md5 FROM rel JOIN texts USING (doc_id)""",
    "relations_star_blocks": f"WITH {_star(STARRED)} SELECT {_REL} FROM rel",
    "relations_mode_ab": f"WITH {_TITLED} SELECT {_REL} FROM rel",
    "toc_flat": f"""WITH {_star(FLAT)} SELECT doc_id, paragraph_id, head_text AS org, string_agg(tail_text, '|' ORDER BY ord) AS docs FROM rel WHERE kind = '{V.ORG_TITLE}' GROUP BY 1, 2, 3""",
    "toc_star": f"""WITH {_star(STARRED)}, subs AS (
            SELECT doc_id, paragraph_id, head_text AS top_org, tail_text AS org, min(ord) AS o FROM rel WHERE kind = '{V.STAR_ORG}' GROUP BY 1, 2, 3, 4),
        docs AS (SELECT doc_id, paragraph_id, head_text AS org, string_agg(tail_text, '|' ORDER BY ord) AS docs FROM rel WHERE kind = '{V.ORG_TITLE}' GROUP BY 1, 2, 3)
        SELECT doc_id, paragraph_id, top_org, (row_number() OVER (PARTITION BY doc_id, paragraph_id ORDER BY o) - 1)::INTEGER AS sub, org, coalesce(docs, '') AS docs FROM subs LEFT JOIN docs USING (doc_id, paragraph_id, org)""",
    "toc_org_ids": f"WITH {_TITLED}, {_IDS} SELECT doc_id, id, text, label FROM ids",
    "toc_items": f"""WITH {_TITLED}, {_IDS}, org_list AS (
            SELECT doc_id, paragraph_id, string_agg(id::VARCHAR, '|' ORDER BY o) AS org_ids FROM (SELECT r.doc_id, paragraph_id, id, min(ord) AS o FROM rel r JOIN ids i ON i.doc_id = r.doc_id AND i.text = r.head_text AND i.label = r.head_label GROUP BY 1, 2, 3) GROUP BY 1, 2),
        names AS (SELECT doc_id, paragraph_id, coalesce(min_by(CASE WHEN kind = '{V.ORG_TITLE}' THEN tail_text END, CASE WHEN kind = '{V.ORG_TITLE}' THEN ord END), min_by(CASE WHEN head_label = '{V.TITLE}' THEN head_text END, CASE WHEN head_label = '{V.TITLE}' THEN ord END)) AS doc_name,
            string_agg(CASE WHEN kind IN ('{V.TITLE_BODY}', '{V.TITLE_PARAGRAPH}') THEN tail_text END, '|' ORDER BY ord) AS ct, string_agg(CASE WHEN kind IN ('{V.ORG_BODY}', '{V.ORG_PARAGRAPH}') THEN tail_text END, '|' ORDER BY ord) AS co FROM rel GROUP BY 1, 2)
        SELECT doc_id, paragraph_id, coalesce(org_ids, '') AS org_ids, doc_name, coalesce(CASE WHEN doc_name IS NULL THEN co ELSE ct END, '') AS children FROM names LEFT JOIN org_list USING (doc_id, paragraph_id)""",
    "split_on_repeat_key": f"""WITH {_spans(SPLIT)}, last AS (SELECT doc_id, max_by("end", seq) AS marker_end FROM ev WHERE label = '{V.SUMMARY}' GROUP BY 1),
        orgs AS (SELECT e.*, {_LETTERS} AS k, marker_end, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS r FROM ev e JOIN last USING (doc_id) WHERE label = '{V.ORG}' AND start >= marker_end),
        firsts AS (SELECT doc_id, text AS first_org, k AS fk FROM orgs WHERE r = 1),
        bounds AS (SELECT doc_id, coalesce(min(CASE WHEN k = fk THEN start END), min(CASE WHEN contains(fk, k) AND length(k) < length(fk) THEN start END)) AS boundary FROM orgs JOIN firsts USING (doc_id) WHERE r > 1 GROUP BY 1)
        SELECT doc_id, CASE WHEN marker_end IS NULL THEN 'no_sumario' WHEN first_org IS NULL THEN 'no_org_after_sumario' WHEN boundary IS NULL THEN 'no_repeat_match' END AS reason, marker_end, first_org, boundary, marker_end AS summary_start,
            CASE WHEN marker_end IS NOT NULL THEN coalesce(boundary, n) END AS summary_end, CASE WHEN marker_end IS NULL THEN 0 ELSE coalesce(boundary, n) END AS body_start, n AS body_end
        FROM (SELECT doc_id, max("end") AS n FROM ev GROUP BY 1) LEFT JOIN last USING (doc_id) LEFT JOIN firsts USING (doc_id) LEFT JOIN bounds USING (doc_id)""",
    "anchor_slices": f"""WITH {_spans(STARRED)} SELECT doc_id, seq::INTEGER AS seq, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), n) AS stop
        FROM ev JOIN (SELECT doc_id, max("end") AS n FROM ev GROUP BY 1) USING (doc_id) WHERE label IN ({_ORGS})""",
    "coalesced_anchors": f"""WITH RECURSIVE {_spans(STARRED)}, orgs AS (
            SELECT *, row_number() OVER w AS i, lead(text) OVER w AS t1, lead(text, 2) OVER w AS t2, lead(seq) OVER w = seq + 1 AS g1, lead(seq, 2) OVER w = seq + 2 AS g2, lead("end") OVER w AS e1, lead("end", 2) OVER w AS e2 FROM ev WHERE label IN ({_ORGS}) WINDOW w AS (PARTITION BY doc_id ORDER BY start)),
        wide AS (SELECT *, CASE WHEN g1 AND g2 AND {_KEY.format("text || t1 || t2")} IN ({_WANTED}) THEN 3 WHEN g1 AND {_KEY.format("text || t1")} IN ({_WANTED}) THEN 2 WHEN {_KEY.format("text")} IN ({_WANTED}) THEN 1 ELSE 0 END AS width FROM orgs),
        walk(doc_id, i) AS (SELECT doc_id, 1::BIGINT FROM (SELECT DISTINCT doc_id FROM orgs) UNION ALL SELECT p.doc_id, p.i + greatest(width, 1) FROM walk p JOIN wide USING (doc_id, i))
        SELECT doc_id, start, CASE width WHEN 3 THEN e2 WHEN 2 THEN e1 ELSE "end" END AS "end", {_KEY.format("CASE width WHEN 3 THEN text || t1 || t2 WHEN 2 THEN text || t1 ELSE text END")} AS org_key, label, width FROM walk JOIN wide USING (doc_id, i) WHERE width > 0""",
    "ordered_doc_match": f"WITH RECURSIVE {_MATCHED} SELECT doc_id, string_agg(hit::VARCHAR, ',' ORDER BY k) AS found FROM walk WHERE k > 0 GROUP BY doc_id",
    "header_blocks": f"""WITH {_spans(FLAT)}, runs AS (SELECT *, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS run FROM ev WHERE label = '{V.TITLE}')
        SELECT doc_id, min(start) AS start, max("end") AS "end", string_agg(text, '|' ORDER BY seq) AS headers, lead(min(start)) OVER (PARTITION BY doc_id ORDER BY min(start)) AS body_stop FROM runs GROUP BY doc_id, run""",
    "export_csv_rows": f"WITH {_TITLED} SELECT doc_id, ord, paragraph_id, kind, head_label, head_text, tail_label, tail_text FROM rel",
    "export_by_head": f"""WITH {_star(STARRED)}, kinds AS (SELECT doc_id, paragraph_id, head_text AS head, head_label, kind, string_agg(tail_text, '|' ORDER BY ord) AS tails FROM rel GROUP BY 1, 2, 3, 4, 5)
        SELECT doc_id, paragraph_id, head, head_label, string_agg(kind || '=' || tails, ';' ORDER BY list_position([{", ".join(f"'{k}'" for k in V.KIND_ORDER)}], kind)) AS relations FROM kinds GROUP BY 1, 2, 3, 4""",
    "export_grouped_json": f"""WITH {_star(STARRED)}, paras AS (SELECT doc_id, paragraph_id, min(ord) AS o, string_agg('{{"kind":"' || kind || '","head":{{"text":"' || head_text || '","label":"' || head_label || '"}},"tail":{{"text":"' || tail_text || '","label":"' || tail_label || '"}}}}', ',' ORDER BY ord) AS r FROM rel GROUP BY 1, 2)
        SELECT doc_id, md5('{{"paragraphs":[' || string_agg('{{"paragraph_id":' || coalesce(paragraph_id::VARCHAR, 'null') || ',"relations":[' || r || ']}}', ',' ORDER BY o) || ']}}') AS json_md5 FROM paras GROUP BY doc_id""",
    "window_locate": f"""WITH {_spans(FLAT)}, wins AS (SELECT doc_id, start AS a, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), n) AS b, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS idx
            FROM ev JOIN (SELECT doc_id, max("end") AS n FROM ev GROUP BY 1) USING (doc_id) WHERE label = '{V.ORG}')
        SELECT t.doc_id, t.start, idx::INTEGER AS idx, CASE WHEN idx IS NULL THEN n ELSE coalesce(lead(t.start) OVER (PARTITION BY t.doc_id, idx ORDER BY t.start), b) END AS stop
        FROM ev t JOIN (SELECT doc_id, max("end") AS n FROM ev GROUP BY 1) USING (doc_id) LEFT JOIN wins w ON w.doc_id = t.doc_id AND t.start >= a AND t.start < b WHERE t.label = '{V.TITLE}'""",
}
