"""Queries that match names: titles, windows, trigrams, children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import text as T
from spanforge.functions import vocabulary as V
from spanforge.operators import segment as S
from spanforge.sources.tables import table


def _changed(name: Column, number: Column) -> Column:
    """A name as a body would show it: as it is, in capitals, letter-spaced, cut, or with a colon."""
    spaced = F.trim(F.regexp_replace(name, "(.)", "$1 "))
    return F.when(number % 5 == 0, name).when(number % 5 == 1, F.upper(name)).when(number % 5 == 2, spaced).when(number % 5 == 3, F.substring(name, F.lit(1), F.length(name) - 2)).otherwise(F.concat(F.lit("**"), name, F.lit(":**")))


def _titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Part names of a size are the titles wanted and, changed, the titles of a body."""
    parts = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("doc_id"), "p_partkey", "p_name")
    wanted = parts.select("doc_id", F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return wanted, parts.select("doc_id", (F.col("p_partkey") * 7 % 10007).alias("start"), _changed(F.col("p_name"), F.col("p_partkey")).alias("title"))


def title_match_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.title_matches(*_titles(spark, sf_dir), contained=False)


def title_match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.title_matches(*_titles(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


def best_window_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part the part type, among those of its size, whose words are most like its name and type's."""
    parts = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("doc_id"), "p_partkey", "p_name", "p_type", "p_brand")
    orgs = parts.select("doc_id", F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    windows = parts.groupBy("doc_id", F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("idx"))
    return S.best_windows(orgs, windows).withColumn("score", F.round("score", 6))


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of benchmark items against all lines of documents, by trigrams of letters."""

    def numbered(name: str, key: str, side: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(key).alias(side), F.posexplode(F.split("text", "\n", -1)).alias(f"{side}_line", "text"))

    return S.similar_lines(numbered("benchmark", "item_id", "a"), numbered("documents", "doc_id", "b")).withColumn("jaccard", F.round("jaccard", 6))


def ordinal_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th order of a customer with the k-th line of the supplier of the same number; extra orders stay, extra lines drop."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"), "l_orderkey", "l_linenumber")
    slices = orders.withColumn("k", F.row_number().over(W.partitionBy("key").orderBy("o_orderkey")))
    named = items.withColumn("k", F.row_number().over(W.partitionBy("key").orderBy("l_orderkey", "l_linenumber")))
    return slices.join(named, ["key", "k"], "left")


def allowed_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct titles of a conversation's texts by their tight key, the first of each kept."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.split("text", "\n", -1)).alias("line"), F.lit(0).alias("z"))
    keyed = rows.select("conv_id", "turn", T.title_norm("line").alias("title"), T.casefold(T.tighten(T.title_norm("line"))).alias("key")).where("key <> ''")
    return keyed.groupBy("conv_id", "key").agg(F.min("turn").alias("turn"), F.min_by("title", F.struct("turn", "title")).alias("title"))


def child_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each turn the benchmark-like title among the first lines of its conversation's turns that its own lines stand for."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "header"))
    allowed = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ord"), F.lower(F.substring_index("text", "\n", 1)).alias("title"))
    found = S.likely_children(rows.select("conv_id", F.col("turn").alias("block"), "line_no", "header"), allowed, "conv_id")
    return found.select("conv_id", F.col("block").alias("turn"), F.md5("title").alias("title_md5"), "rank")


QUERIES = {f.__name__: f for f in (title_match_equal, title_match_cascade, best_window_jaccard, ngram_jaccard, ordinal_zip, allowed_children, child_titles)}

# --- The same in SQL ---------------------------------------------------------

_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_PLAIN = f"translate({{0}}, '{V.ACCENTED}', '{V.BASE}')"


def _norm(c: str) -> str:
    s = _STRIP.format(c)
    inner = f"CASE WHEN length({s}) >= 4 AND starts_with({s}, '**') AND suffix({s}, '**') THEN ({s})[3:-3] ELSE {s} END"
    collapsed = _STRIP.format(f"regexp_replace({inner}, '\\s+', ' ', 'g')")
    return _STRIP.format(f"regexp_replace({collapsed}, ':$', '')")


def _letters(c: str) -> str:
    return f"regexp_replace(lower({_PLAIN.format(c)}), '[^a-z0-9]', '', 'g')"


def passes() -> str:
    out, left, free = [], "wanted", "titles"
    for n, name in enumerate(("exact", "tight", "letters")):
        out.append(f"""hit{n} AS (SELECT doc_id, item, start, {V.CONFIDENCE[name]}::DOUBLE AS confidence FROM
            (SELECT *, row_number() OVER (PARTITION BY doc_id, {name} ORDER BY item) AS k FROM {left} WHERE {name} <> '') JOIN
            (SELECT *, row_number() OVER (PARTITION BY doc_id, {name} ORDER BY start) AS k FROM {free} WHERE {name} <> '') USING (doc_id, {name}, k)),
        left{n} AS (SELECT * FROM {left} ANTI JOIN hit{n} USING (doc_id, item)), free{n} AS (SELECT * FROM {free} ANTI JOIN hit{n} USING (doc_id, start))""")
        left, free = f"left{n}", f"free{n}"
    return ",\n".join(out)


#: After passes(): what is left, contained in one another, the longest wanted title first, each taking its best free place.
CONTAINED = f"""near AS (
    SELECT a.doc_id, a.item, b.start, least(length(a.letters), length(b.letters))::DOUBLE / greatest(length(a.letters), length(b.letters)) AS ratio
    FROM left2 a JOIN free2 b ON a.doc_id = b.doc_id AND a.letters <> '' AND b.letters <> '' AND (contains(a.letters, b.letters) OR contains(b.letters, a.letters))
), close AS (SELECT * FROM near WHERE ratio >= {V.LEAST_RATIO}),
turns AS (SELECT doc_id, item, row_number() OVER (PARTITION BY doc_id ORDER BY length(letters) DESC, item) AS k FROM left2 SEMI JOIN close USING (doc_id, item)),
assign(doc_id, k, taken, item, start, ratio) AS (
    SELECT doc_id, 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM (SELECT DISTINCT doc_id FROM turns)
    UNION ALL
    SELECT p.doc_id, t.k, CASE WHEN count(c.start) > 0 THEN list_append(p.taken, arg_min(c.start, (-c.ratio, c.start))) ELSE p.taken END, t.item, arg_min(c.start, (-c.ratio, c.start)), max(c.ratio)
    FROM assign p JOIN turns t ON t.doc_id = p.doc_id AND t.k = p.k + 1 LEFT JOIN close c ON c.doc_id = t.doc_id AND c.item = t.item AND NOT list_contains(p.taken, c.start)
    GROUP BY p.doc_id, t.k, t.item, p.taken
), hit3 AS (SELECT doc_id, item, start, {V.CONFIDENCE["contained"]}::DOUBLE * ratio AS confidence FROM assign WHERE start IS NOT NULL),
matched AS (SELECT doc_id, item, start, round(confidence, 6) AS confidence FROM (SELECT * FROM hit0 UNION ALL SELECT * FROM hit1 UNION ALL SELECT * FROM hit2 UNION ALL SELECT * FROM hit3))"""

KEYS = f"lower({_norm('title')}) AS exact, replace(lower({_norm('title')}), ' ', '') AS tight, {_letters(_norm('title'))} AS letters"
_TITLES = f"""names AS (
    SELECT p_size::BIGINT AS doc_id, p_partkey, p_name, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN trim(regexp_replace(p_name, '(.)', '\\1 ', 'g'))
        WHEN 3 THEN left(p_name, length(p_name) - 2) ELSE '**' || p_name || ':**' END AS changed FROM part
), wanted AS (SELECT doc_id, p_partkey AS item, {KEYS} FROM (SELECT *, p_name AS title FROM names)),
titles AS (SELECT doc_id, p_partkey * 7 % 10007 AS start, {KEYS} FROM (SELECT *, changed AS title FROM names))"""
_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda t: t <> ''))"
_GRAMS = "list_distinct(list_transform(range(1, length(l) - 1), lambda i: l[i:i + 2]))"

ORACLES = {
    "title_match_cascade": f"WITH RECURSIVE {_TITLES}, {passes()}, {CONTAINED} SELECT * FROM matched",
    "title_match_equal": f"WITH {_TITLES}, {passes()} SELECT * FROM hit0 UNION ALL SELECT * FROM hit1 UNION ALL SELECT * FROM hit2",
    "best_window_jaccard": f"""WITH orgs AS (SELECT p_size::BIGINT AS doc_id, p_partkey AS id, {_TOKENS.format("p_name || ' ' || p_type")} AS a FROM part),
        wins AS (SELECT p_size::BIGINT AS doc_id, {_TOKENS.format("p_type")} AS b, min(p_partkey) AS idx FROM part GROUP BY p_size, p_type),
        scored AS (SELECT doc_id, id, idx, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS score FROM orgs JOIN wins USING (doc_id)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY score DESC, idx) AS r FROM scored)
        SELECT doc_id, id, idx, round(score, 6) AS score, CASE WHEN score > 0 THEN 'org_anchored' ELSE 'org_unanchored' END AS status FROM ranked WHERE r = 1""",
    "allowed_children": f"""SELECT conv_id, key, min(turn) AS turn, arg_min(title, (turn, title)) AS title FROM (
        SELECT conv_id, turn, {_norm("line")} AS title, replace(lower(replace({_norm("line")}, ' ', '')), 'ß', 'ss') AS key FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)) WHERE key <> '' GROUP BY conv_id, key""",
    "child_titles": f"""WITH rows_ AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS header, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM conversations),
        keyed AS (SELECT conv_id, turn, line_no, replace(lower({_norm("header")}), 'ß', 'ss') AS e, replace(replace(lower({_norm("header")}), 'ß', 'ss'), ' ', '') AS t, {_letters(_norm("header"))} AS l FROM rows_),
        allowed AS (SELECT conv_id, turn AS ord, title, replace(lower({_norm("title")}), 'ß', 'ss') AS e, replace(replace(lower({_norm("title")}), 'ß', 'ss'), ' ', '') AS t, {_letters(_norm("title"))} AS l FROM (SELECT conv_id, turn, lower(string_split(text, chr(10))[1]) AS title FROM conversations)),
        pairs AS (SELECT k.conv_id, k.turn, line_no, ord, title, k.e AS he, a.e AS ae, k.t AS ht, a.t AS att, k.l AS hl, a.l AS al,
            least(length(k.l), length(a.l))::DOUBLE / greatest(length(k.l), length(a.l), 1) AS ratio, list_distinct(list_transform(range(1, length(k.l) - 1), lambda i: k.l[i:i + 2])) AS hg, list_distinct(list_transform(range(1, length(a.l) - 1), lambda i: a.l[i:i + 2])) AS ag FROM keyed k JOIN allowed a USING (conv_id)),
        ranked AS (SELECT *, CASE WHEN he = ae AND ae <> '' THEN 0 WHEN ht = att AND att <> '' THEN 1 WHEN hl = al AND al <> '' THEN 2 WHEN hl <> '' AND al <> '' AND (contains(hl, al) OR contains(al, hl)) AND ratio >= {V.LEAST_RATIO} THEN 3
            WHEN length(hl) >= {V.LEAST_GRAM_LETTERS} AND length(al) >= {V.LEAST_GRAM_LETTERS} AND len(list_intersect(hg, ag))::DOUBLE / len(list_distinct(list_concat(hg, ag))) >= {V.LEAST_JACCARD} THEN 4 END AS rank FROM pairs),
        scored AS (SELECT *, CASE rank WHEN 3 THEN ratio WHEN 4 THEN len(list_intersect(hg, ag))::DOUBLE / len(list_distinct(list_concat(hg, ag))) ELSE 1 END AS score FROM ranked WHERE rank IS NOT NULL),
        first AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY line_no, rank, score DESC, ord) AS r FROM scored)
        SELECT conv_id, turn, md5(title) AS title_md5, rank::INTEGER AS rank FROM first WHERE r = 1""",
}


def _line_grams(name: str, key: str, side: str) -> str:
    split = f"SELECT {key}, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no, unnest(string_split(text, chr(10))) AS line FROM {name} WHERE text IS NOT NULL"
    return f"""SELECT {side}, {side}_line, len(g) AS n_{side}, unnest(g) AS gram FROM (SELECT {key} AS {side}, line_no AS {side}_line, {_GRAMS} AS g FROM (SELECT {key}, line_no, {_letters("line")} AS l FROM ({split})) WHERE length(l) >= {V.LEAST_GRAM_LETTERS})"""


ORACLES["ngram_jaccard"] = f"""WITH a AS ({_line_grams("benchmark", "item_id", "a")}), b AS ({_line_grams("documents", "doc_id", "b")})
    SELECT a, a_line, b, b_line, round(count(*)::DOUBLE / (n_a + n_b - count(*)), 6) AS jaccard FROM a JOIN b USING (gram) GROUP BY a, a_line, b, b_line, n_a, n_b HAVING count(*)::DOUBLE / (n_a + n_b - count(*)) >= {V.LEAST_JACCARD}"""
ORACLES["ordinal_zip"] = """SELECT key, k, o_orderkey, l_orderkey, l_linenumber FROM
    (SELECT o_custkey AS key, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) LEFT JOIN
    (SELECT l_suppkey AS key, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem) USING (key, k)"""
