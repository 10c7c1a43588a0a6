"""Queries over the documents, pages and benchmark tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.functions import predicates as P
from spanforge.functions import text as T
from spanforge.functions import vocabulary as V
from spanforge.operators import labels as L
from spanforge.operators import markdown as M
from spanforge.operators.lines import lines, visible
from spanforge.sources import markdown as issues
from spanforge.sources.tables import table


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def line_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(docs(spark, sf_dir)).select("doc_id", "line_no", "start", "end")


def line_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass without a shuffle of texts: lines need no offsets here."""
    rows = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "\n", -1)).alias("line"))
    kind = F.when(P.is_blank("line"), "blank").when(P.is_table_row("line"), "table").when(P.is_junk_line("line"), "junk").when(P.is_org_line("line") & P.has_star("line"), "org_star").when(P.is_org_line("line"), "org").otherwise("text")
    return rows.groupBy("lang", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(P.starts_upper("line").cast("long")).alias("n_upper"),
        F.sum(P.ends_sentence("line").cast("long")).alias("n_ended"),
        F.sum(P.starts_list("line").cast("long")).alias("n_listed"),
    )


def noisy_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with noise and fixed phrases, which those of the table lack: of each third line a short one becomes a noise line, a heading gets a phrase behind it, another one before it."""
    line = lambda x: F.when(F.length(x) < 12, F.concat(F.lit("- "), F.length(x).cast("string"), F.lit(" ·"))).when(P.is_org_line(x), F.concat(x, F.lit(" Direção Regional do Trabalho"))).otherwise(F.concat(F.lit("**Sumário** "), x))
    text = F.array_join(F.transform(F.split("text", "\n", -1), lambda x, i: F.when(i % 3 == 0, line(x)).otherwise(x)), "\n")
    return docs(spark, sf_dir).select("doc_id", text.alias("text"))


def junk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible(lines(noisy_docs(spark, sf_dir)).where(P.is_junk_line("line"))).select("doc_id", "line_no", "start", "end")


def caps_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.heading_runs(docs(spark, sf_dir))


def bold_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.bold_blocks(docs(spark, sf_dir)).withColumn("is_title", P.is_title_bold("content"))


def span_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.headings_and_titles(docs(spark, sf_dir))


def doc_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.labelled_lines(docs(spark, sf_dir)).where(F.col("label") == V.BODY).select("doc_id", "start", "end")


def paragraph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.label(docs(spark, sf_dir)).where(F.col("label").isin(V.PARAGRAPH, V.BODY))


def repeated_key_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose keys repeat or are null: each row has the spans that it would have alone."""
    key = F.when(F.col("doc_id") % 50 != 0, F.col("doc_id") % 50)
    return L.label(docs(spark, sf_dir).select(key.alias("doc_id"), "text"))


def noisy_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of texts with noise and fixed phrases."""
    return L.label(noisy_docs(spark, sf_dir))


def span_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: spans and characters of each label by language, from one scan: language and row go through labelling as the key."""
    rows = table(spark, sf_dir, "documents").select(F.struct("doc_id", "lang").alias("doc"), "text")
    by_doc = L.label(rows, "doc").groupBy("doc", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("chars"))
    return by_doc.groupBy(F.col("doc.lang").alias("lang"), "label").agg(F.sum("n").alias("n_spans"), F.sum("chars").alias("n_chars"), F.count(F.lit(1)).alias("n_docs"))


def _keys(name: str) -> list[Column]:
    return [T.match_key(name).alias("match_key"), T.letters_key(name).alias("letters_key"), T.org_key(name).alias("org_key"), T.ascii_letters(name).alias("ascii_letters"), T.title_norm(name).alias("title_norm"), T.collapse_spaces(T.strip_bold(name)).alias("plain"), T.tighten(name).alias("tight"), F.size(T.tokens(name)).alias("n_tokens")]


def norm_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all lines of documents and benchmark."""
    texts = docs(spark, sf_dir).select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("source"), F.col("item_id").alias("id"), "text")
    rows = texts.unionByName(items).select("source", "id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.select("source", "id", "line_no", *_keys("line"))


def join_spaced_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.select("doc_id", "line_no", T.plain_text("line").alias("plain")).where(F.length("plain") > 0)


def issue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as the pages of an issue, each under two bold lines in capitals: joined without the last page, bold lines merged."""
    page = F.concat(F.lit("**"), F.upper("role"), F.lit("**\n**TURN**\n"), F.coalesce("text", F.lit("")))
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page_no"), page.alias("md"))
    return issues.issue_texts(pages, "conv_id").select("conv_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def markdown_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").where(F.col("text").contains("|")).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.where(F.col("line").contains("|")).select("doc_id", "line_no", P.is_table_row("line").alias("is_row"), P.is_all_caps("line").alias("is_caps"))


def merge_bold_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bold-only lines are made from heading lines, which these texts have, and merged again."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    line = F.when(P.is_org_line("line") | (F.length("line") < 40), F.concat(F.lit("**"), F.col("line"), F.lit("**"))).otherwise(F.col("line"))
    bold = rows.select("doc_id", "line_no", line.alias("line"))
    merged = M.merge_bold_runs(bold).withColumn("rule", F.lit("any")).unionByName(M.merge_bold_runs(bold, all_caps=True).withColumn("rule", F.lit("caps")))
    return merged.select("doc_id", "rule", "line_no", "n_lines", F.md5("text").alias("text_md5"))


def inline_bold_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").where(F.col("text").contains("**")).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.where(F.col("line").contains("**")).select("doc_id", "line_no", F.md5(M.one_bold_block("line")).alias("one_md5"), F.md5(M.unglue_bold("line")).alias("unglued_md5"))


def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.html_escape("html")).alias("escaped_md5"), F.length(T.html_escape("url")).alias("n_url"))


def text_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file for each document: name from the key and a slug, contents between marks."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    name = F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.lit("_"), T.slug(F.substring_index("text", "\n", 1)), F.lit(".txt"))
    body = F.concat_ws("\n", F.lit("DOC_BEGIN"), F.concat(F.lit("ORG: "), T.strip(F.substring_index("text", "\n", 1))), F.col("text"), F.lit("DOC_END"))
    return rows.select("doc_id", name.alias("name"), F.md5(body).alias("body_md5"))


def filename_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing by name, as for issue files: the path's parts of each url."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.lower(F.regexp_extract(url, r"//([^/?#]+)", 1)).alias("host"),
        F.regexp_extract(url, r"/([a-z]{2})/(\d+)", 1).alias("series"),
        F.regexp_extract(url, r"/([a-z]{2})/(\d+)", 2).try_cast("int").alias("number"),
        F.lower(url).contains("/en/").alias("is_en"),
    )


def slice_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the spans of each document cover: they do not overlap, so lengths add up."""
    spans = L.label(docs(spark, sf_dir))
    return spans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("covered"), F.min("start").alias("first"), F.max("end").alias("last"))


QUERIES = {f.__name__: f for f in (line_offsets, line_class_counts, junk_lines, caps_runs, bold_blocks, span_resolution, doc_text_lines, paragraph_merge, repeated_key_spans, noisy_spans, span_report, norm_keys, join_spaced_caps, issue_texts, markdown_table_rows, merge_bold_runs, inline_bold_clean, html_escape, text_envelope, filename_series, slice_property)}

# --- The same in SQL ---------------------------------------------------------

_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_MARKS = T.rx_class(V.JUNK_MARKS).replace("'", "''")
_JUNK = f"(regexp_matches({_STRIP.format('line')}, '^[\\d\\s{_MARKS}]{{1,{V.JUNK_LENGTH}}}$') AND NOT contains(line, '|'))"
_ORG = "(regexp_matches(line, '\\p{L}') AND NOT regexp_matches(line, '\\p{Ll}'))"
_LEAD = "^[\\p{P}\\p{S}\\s]*"
_UPPER = f"regexp_matches(line, '{_LEAD}(?:\\p{{Nd}}|[\\p{{Lu}}\\p{{Lt}}\\p{{Lm}}\\p{{Lo}}])')"
_LOWER = f"regexp_matches(line, '{_LEAD}\\p{{Ll}}')"
_ENDED = f"regexp_matches({_STRIP.format('line')}, '[.!?]$')"
_ROW = f"({_STRIP.format('line')}[1] = '|' AND (suffix({_STRIP.format('line')}, '|') OR length(line) - length(replace(line, '|', '')) >= 3 OR regexp_matches({_STRIP.format('line')}, '[-:]{{3,}}')))"
_COMPAT = f"translate({{0}}, '{V.ACCENTED}{V.ORDINALS}', '{V.BASE}{V.ORDINAL_BASE}')"
_PLAIN = f"translate({{0}}, '{V.ACCENTED}', '{V.BASE}')"
_MATCH = "replace(lower(regexp_replace(" + _COMPAT + ", '\\s+', '', 'g')), 'ß', 'ss')"
_TITLES = ", ".join(f"'{k}'" for k in T.known_title_keys())
_SPLIT = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no FROM documents WHERE text IS NOT NULL)"
_LINES = f"""lines AS (
    SELECT doc_id, line_no, line, start, start + length(line) AS "end" FROM (
        SELECT doc_id, line_no, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM {_SPLIT})
), visible AS (
    SELECT doc_id, line_no, {_STRIP.format("line")} AS line, start + length(line) - length(regexp_replace(line, '^\\s+', '')) AS start,
           start + length(regexp_replace(line, '\\s+$', '')) AS "end" FROM lines WHERE regexp_matches(line, '\\S')
)"""
_RUNS = f"""runs AS (
    SELECT doc_id, label, min(start) AS start, max("end") AS "end", count(*) AS n_lines FROM (
        SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, label ORDER BY line_no) AS run FROM (
            SELECT *, CASE WHEN contains(line, '*') THEN '{V.ORG_STAR}' ELSE '{V.ORG}' END AS label FROM visible WHERE {_ORG}))
    GROUP BY doc_id, label, run
)"""
_BOLD = f"""pieces AS (
    SELECT doc_id, i, piece, (sum(length(piece) + 2) OVER w - length(piece) - 2)::BIGINT AS start_, lag(piece) OVER w AS gap, lead(i) OVER w AS closed
    FROM (SELECT doc_id, unnest(string_split(text, '**')) AS piece, unnest(range(len(string_split(text, '**')))) AS i FROM documents WHERE contains(text, '**'))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), bold AS (
    SELECT doc_id, min(start_) - 2 AS start, max(start_ + length(piece)) + 2 AS "end", string_agg(shown, '' ORDER BY i) AS content FROM (
        SELECT *, sum(1 - joined) OVER (PARTITION BY doc_id ORDER BY i) AS run, CASE WHEN joined = 1 THEN '**' || gap || '**' || piece ELSE piece END AS shown FROM (
            SELECT *, (i > 1 AND regexp_matches(gap, '^[ \\t\\r\\f\\v]*$'))::INTEGER AS joined FROM pieces WHERE i % 2 = 1 AND closed IS NOT NULL))
    GROUP BY doc_id, run
), bold_titles AS (
    SELECT *, {_MATCH.format("content")} IN ({_TITLES}) OR regexp_matches(content, '[\\p{{Ll}}ªº]') AS is_title FROM bold
)"""
_PHRASES = ",\n".join(
    f"""phrase{n} AS (SELECT doc_id, '{label}' AS label, e - {len(p)} AS start, e AS "end" FROM (
    SELECT doc_id, (sum(length(piece) + {len(p)}) OVER w)::BIGINT AS e, lead(i) OVER w AS after FROM (
        SELECT doc_id, unnest(string_split(text, '{p}')) AS piece, unnest(range(len(string_split(text, '{p}')))) AS i FROM documents WHERE contains(text, '{p}'))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE after IS NOT NULL)"""
    for n, (p, label) in enumerate(V.PHRASES.items())
)


def _chosen(name: str, candidates: str) -> str:
    return f"""{name} AS (
    SELECT doc_id, unnest(list_reduce(list_prepend([]::STRUCT(less BIGINT, start BIGINT, rank INTEGER, label VARCHAR, "end" BIGINT)[], list_transform(spans, lambda s: [s])),
        lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.start < x[1]."end" AND k."end" > x[1].start)) > 0 THEN acc ELSE list_concat(acc, x) END), recursive := true)
    FROM (SELECT doc_id, list({{'less': start - "end", 'start': start, 'rank': rank, 'label': label, 'end': "end"}} ORDER BY start - "end", start, rank, label) AS spans FROM ({candidates}) GROUP BY doc_id)
)"""


_PHRASE_ROWS = " UNION ALL ".join(f'SELECT doc_id, label, start, "end", 0 AS rank FROM phrase{n}' for n in range(len(V.PHRASES)))
_RUN_ROWS = """SELECT doc_id, label, start, "end", 1 AS rank FROM runs"""
_TITLE_ROWS = f"""SELECT doc_id, '{V.TITLE}' AS label, start, "end", 2 AS rank FROM bold_titles WHERE is_title"""
_LABELS = f"""{_LINES}, {_RUNS}, {_BOLD}, {_PHRASES}, {_chosen("headed", _PHRASE_ROWS + " UNION ALL " + _RUN_ROWS)}, {_chosen("chosen", 'SELECT doc_id, label, start, "end", 0 AS rank FROM headed UNION ALL ' + _TITLE_ROWS)}, junk AS (
    SELECT doc_id, start, "end" FROM visible v WHERE {_JUNK} AND NOT EXISTS (SELECT 1 FROM chosen c WHERE c.doc_id = v.doc_id AND c.start < v."end" AND c."end" > v.start)
), fixed AS (
    SELECT doc_id, label, start, "end" FROM chosen UNION ALL SELECT doc_id, '{V.JUNK}', start, "end" FROM junk
), free AS (
    SELECT doc_id, line, start, "end" FROM visible v WHERE NOT EXISTS (SELECT 1 FROM fixed c WHERE c.doc_id = v.doc_id AND c.start < v."end" AND c."end" > v.start)
), marked AS (
    SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM (SELECT doc_id, label, start, "end", NULL AS line FROM fixed UNION ALL SELECT doc_id, '{V.BODY}', start, "end", line FROM free)
), grouped AS (
    SELECT *, sum((before IS NULL OR line IS NULL OR ({_ENDED.replace("line", "before")} AND NOT {_LOWER}))::INTEGER) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM marked
), opened AS (
    SELECT *, line IS NOT NULL AND coalesce(max({_UPPER}::INTEGER) OVER (PARTITION BY doc_id, run ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS opened FROM grouped
), labelled AS (
    SELECT doc_id, label, start, "end" FROM opened WHERE NOT opened
    UNION ALL SELECT doc_id, CASE WHEN count(*) > 1 THEN '{V.PARAGRAPH}' ELSE '{V.BODY}' END, min(start), max("end") FROM opened WHERE opened GROUP BY doc_id, run
)"""
_NOISY = f"""made AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i: CASE WHEN i % 3 <> 1 THEN line WHEN length(line) < 12 THEN '- ' || length(line) || ' ·'
    WHEN {_ORG} THEN line || ' Direção Regional do Trabalho' ELSE '**Sumário** ' || line END), chr(10)) AS text FROM documents)"""
_BOLDED = f"(SELECT doc_id, line_no, CASE WHEN {_ORG} OR length(line) < 40 THEN '**' || line || '**' ELSE line END AS line FROM {_SPLIT})"
_INNER = "regexp_extract(line, '^\\s*\\*\\*(.+)\\*\\*\\s*$', 1)"
_LATIN = f"regexp_replace({_INNER}, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')"


def _merged(rule: str, bold: str) -> str:
    return f"""SELECT doc_id, '{rule}' AS rule, min(line_no) AS line_no, count(*) AS n_lines,
        md5(CASE WHEN bool_or(bold) THEN '**' || string_agg(inner_, chr(10) ORDER BY line_no) || '**' ELSE any_value(line) END) AS text_md5 FROM (
        SELECT *, sum(CASE WHEN bold AND coalesce(was, false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM (
            SELECT *, lag(bold) OVER (PARTITION BY doc_id ORDER BY line_no) AS was FROM (SELECT *, {_INNER} AS inner_, {bold} AS bold FROM {_BOLDED})))
    GROUP BY doc_id, run"""


def _made(ctes: str) -> str:
    return ctes.replace("FROM documents", "FROM made")


_FIRST = "(SELECT doc_id, string_split(text, chr(10))[1] AS f FROM documents)"
_CAPS_CLASS = V.SPACED_CAPS
_NO_BOLD = "regexp_replace(replace({0}, '**', ''), '^\\s+|\\s+$', '', 'g')"
_COLLAPSED = "regexp_replace(regexp_replace({0}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
_UNBOLD_OUTER = "CASE WHEN length({0}) >= 4 AND starts_with({0}, '**') AND suffix({0}, '**') THEN {0}[3:-3] ELSE {0} END"
_UNGLUED = "regexp_replace(regexp_replace(line, '([A-Za-zÀ-ÖØ-öø-ÿ0-9])\\*\\*', '\\1 **', 'g'), '\\*\\*([A-Za-zÀ-ÖØ-öø-ÿ0-9])', '** \\1', 'g')"
_BARE = _COLLAPSED.format(f"replace({_UNGLUED}, '**', '')")

ORACLES = {
    "line_offsets": f'WITH {_LINES} SELECT doc_id, line_no, start, "end" FROM lines',
    "line_class_counts": f"""SELECT lang, CASE WHEN NOT regexp_matches(line, '\\S') THEN 'blank' WHEN {_ROW} THEN 'table' WHEN {_JUNK} THEN 'junk' WHEN {_ORG} AND contains(line, '*') THEN 'org_star' WHEN {_ORG} THEN 'org' ELSE 'text' END AS kind,
        count(*) AS n, sum({_UPPER}::INTEGER)::BIGINT AS n_upper, sum({_ENDED}::INTEGER)::BIGINT AS n_ended, sum(regexp_matches(line, '^\\s*(?:[-•—–]|\\d+\\s*[).])')::INTEGER)::BIGINT AS n_listed
        FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1, 2""",
    "junk_lines": f'WITH {_NOISY}, {_made(_LINES)} SELECT doc_id, line_no, start, "end" FROM visible WHERE {_JUNK}',
    "noisy_spans": f"WITH {_NOISY}, {_made(_LABELS)} SELECT * FROM labelled",
    "repeated_key_spans": f'WITH {_LABELS} SELECT CASE WHEN doc_id % 50 <> 0 THEN doc_id % 50 END AS doc_id, label, start, "end" FROM labelled',
    "caps_runs": f"WITH {_LINES}, {_RUNS} SELECT * FROM runs",
    "bold_blocks": f"WITH {_BOLD} SELECT * FROM bold_titles",
    "span_resolution": f"""WITH {_LINES}, {_RUNS}, {_BOLD}, {_chosen("chosen", _RUN_ROWS + " UNION ALL " + _TITLE_ROWS)} SELECT doc_id, label, start, "end" FROM chosen""",
    "doc_text_lines": f'WITH {_LABELS} SELECT doc_id, start, "end" FROM free',
    "paragraph_merge": f"WITH {_LABELS} SELECT * FROM labelled WHERE label IN ('{V.PARAGRAPH}', '{V.BODY}')",
    "span_report": f"""WITH {_LABELS} SELECT lang, label, count(*) AS n_spans, sum("end" - start)::BIGINT AS n_chars, count(DISTINCT doc_id) AS n_docs FROM labelled JOIN documents USING (doc_id) GROUP BY lang, label""",
    "norm_keys": f"""SELECT doc_id, {_MATCH.format("f")} AS match_key, replace(lower(regexp_replace({_COMPAT.format("f")}, '[^\\p{{L}}]', '', 'g')), 'ß', 'ss') AS letters_key,
        upper(regexp_replace({_PLAIN.format("replace(f, '**', '')")}, '[^A-Za-z0-9]', '', 'g')) AS org_key, regexp_replace(lower({_PLAIN.format("f")}), '[^a-z0-9]', '', 'g') AS ascii_letters,
        {_STRIP.format(f"regexp_replace({_COLLAPSED.format(_UNBOLD_OUTER.format('s'))}, ':$', '')")} AS title_norm, {_COLLAPSED.format(_NO_BOLD.format("f"))} AS plain, replace(f, ' ', '') AS tight,
        len(list_filter(list_distinct(regexp_split_to_array(lower(s), '\\s+')), lambda t: t <> ''))::INTEGER AS n_tokens
        FROM (SELECT *, {_STRIP.format("f")} AS s FROM {_FIRST})""",
    "join_spaced_caps": f"""SELECT doc_id, line_no, array_to_string(list_filter(list_transform(range(1, length(p) + 1), lambda i: CASE
            WHEN p[i] = ' ' AND i > 1 AND regexp_matches(p[i - 1], '[ {_CAPS_CLASS}]') AND regexp_matches(p[i + 1], '[{_CAPS_CLASS}]') THEN '' ELSE p[i] END), lambda c: c <> ''), '') AS plain
        FROM (SELECT doc_id, line_no, {_COLLAPSED.format(_NO_BOLD.format("line"))} AS p FROM {_SPLIT}) WHERE p <> ''""",
    "issue_texts": r"""SELECT conv_id, length(t)::INTEGER AS n_chars, md5(t) AS text_md5 FROM (
        SELECT conv_id, regexp_replace(coalesce(string_agg('**' || upper(role) || chr(10) || 'TURN**' || chr(10) || coalesce(text, ''), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) FILTER (turn < last), ''), '\n$', '') AS t
        FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY conv_id)""",
    "markdown_table_rows": f"""SELECT doc_id, line_no, {_ROW} AS is_row, length(regexp_replace(line, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')) >= 2 AND upper(regexp_replace(line, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')) = regexp_replace(line, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g') AS is_caps
        FROM {_SPLIT} WHERE contains(line, '|')""",
    "merge_bold_runs": f"""{_merged("any", f"{_INNER} <> '' AND NOT {_ROW}")} UNION ALL {_merged("caps", f"{_INNER} <> '' AND NOT {_ROW} AND length({_LATIN}) >= 2 AND upper({_LATIN}) = {_LATIN}")}""",
    "inline_bold_clean": f"""SELECT doc_id, line_no, md5(CASE WHEN {_ROW} OR (starts_with({_STRIP.format("line")}, '**') AND suffix({_STRIP.format("line")}, '**') AND length(line) - length(replace(line, '**', '')) = 4) OR {_BARE} = '' THEN line ELSE '**' || {_BARE} || '**' END) AS one_md5,
        md5({_UNGLUED}) AS unglued_md5 FROM {_SPLIT} WHERE contains(line, '**')""",
    "html_escape": """SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped_md5,
        length(replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'))::INTEGER AS n_url FROM pages""",
    "text_envelope": f"""SELECT doc_id, 'doc_' || lpad(doc_id::VARCHAR, 6, '0') || '_' || left(regexp_replace(f, '[^\\p{{L}}\\p{{N}}_.-]+', '_', 'g'), 120) || '.txt' AS name,
        md5(concat_ws(chr(10), 'DOC_BEGIN', 'ORG: ' || {_STRIP.format("f")}, text, 'DOC_END')) AS body_md5 FROM (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10))[1] AS f FROM documents)""",
    "filename_series": """SELECT page_id, lower(regexp_extract(url, '//([^/?#]+)', 1)) AS host, regexp_extract(url, '/([a-z]{2})/(\\d+)', 1) AS series,
        TRY_CAST(regexp_extract(url, '/([a-z]{2})/(\\d+)', 2) AS INTEGER) AS number, contains(lower(url), '/en/') AS is_en FROM pages""",
    "slice_property": f'WITH {_LABELS} SELECT doc_id, count(*) AS n, sum("end" - start)::BIGINT AS covered, min(start) AS first, max("end") AS last FROM labelled GROUP BY doc_id',
}

_ALL_LINES = " UNION ALL ".join(f"SELECT '{t}' AS source, {k} AS id, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no, unnest(string_split(text, chr(10))) AS f FROM {t} WHERE text IS NOT NULL" for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
ORACLES["norm_keys"] = ORACLES["norm_keys"].replace("SELECT doc_id,", "SELECT source, id, line_no,", 1).replace(_FIRST, f"({_ALL_LINES})")
