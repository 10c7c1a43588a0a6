"""Quality rules with host-level verdicts.

Each document gets counts from its whole text and the rules it breaks.  Rule
failures are added up by host (the column source), and each host's rate is
shrunk towards the rate of all hosts by a beta prior whose two parameters are
fitted to the hosts by moments, so that a host of few documents is not judged
by chance.  The host's verdict goes back to its documents as the number of soft
rules that a document of it may break: TRUSTED on most hosts, DOUBTED on a host
whose shrunk rate is above DOUBT.  A document that breaks none of the rules is
kept on any host.

Base rules (a document that breaks one is not kept): fewer than MIN_WORDS words;
more than MAX_REPEAT_PERCENT of words in repeated windows of WINDOW words.
Soft rules: more than MAX_SYMBOLS_PERCENT symbols a hundred words; more than
MAX_DUP_PERCENT of lines with a word equal to an earlier line; a mean word
length outside MEAN_WORD code points.

Only the narrow counts are shuffled.  They are written once; hosts are grouped
with partial sums, so a host with a third of all documents costs no more; host
verdicts are broadcast if they are at most BROADCAST_HOSTS rows (they are
counted), else joined with SALTS copies of each.

Defined cases: a null text has no words (base_failed, not kept); a null source
is a host of its own; a rate of exactly DOUBT is not doubted; repeated rows are
judged alike; a very long text is counted whole in one task; an empty table gives
no rows; extra columns of the input are not read by judged() and are carried as
they are by accepted(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.llm import common
from spanforge.llm import textbatch as tb

#: Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Soft rules and verdicts.
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_PERCENT = 30
MEAN_WORD = (3, 15)
DOUBT = 0.5
TRUSTED, DOUBTED = 1, 0
BROADCAST_HOSTS = 50_000
SALTS = 32

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def counts(texts: list[str]) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    codes, bounds = tb.pack(texts)
    begin, end, of_words = tb.words(codes, bounds)
    n_words = np.diff(of_words)
    inside = tb.sums(end - begin, of_words)
    symbols = np.zeros(128, bool)
    symbols[[ord(c) for c in SYMBOLS]] = True
    n_symbols = tb.sums(symbols[np.minimum(codes, 127)] & (codes < 127), bounds)

    # Lines: of each text, parted by \n; those with a word are told apart by hash.
    breaks = np.flatnonzero(codes == 10)
    line_begin = np.sort(np.concatenate([breaks + 1, bounds[:-1]]))
    line_end = np.sort(np.concatenate([breaks, bounds[1:]]))
    first_word = np.searchsorted(begin, line_begin)
    worded = (first_word < len(begin)) & (line_begin < line_end)
    worded[worded] = begin[first_word[worded]] < line_end[worded]
    line_begin, line_end = line_begin[worded], line_end[worded]
    text_of_line = np.searchsorted(bounds, line_begin, "right") - 1
    n_lines = np.bincount(text_of_line, minlength=len(texts))
    key = tb.mixed(tb.span_hashes(codes, line_begin, line_end) ^ tb.mixed(text_of_line.astype(np.uint64)))
    _, once = np.unique(key, return_index=True)
    n_dup_lines = n_lines - np.bincount(text_of_line[once], minlength=len(texts))

    # Repeated windows: a word counts if any window over it occurs twice or more in its text.
    hashes, of = tb.windows(tb.span_hashes(codes, begin, end), of_words, WINDOW, short=False)
    key = tb.mixed(hashes ^ tb.mixed(of.astype(np.uint64)))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    first = tb.bounds_of(np.maximum(0, n_words - WINDOW + 1))
    at = np.arange(len(of)) - first[of] + of_words[of]
    at = at[times[which] > 1]
    cover = np.zeros(len(begin) + WINDOW + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    n_repeat = tb.sums((np.cumsum(cover)[: len(begin)] > 0).astype(np.int64), of_words)
    return dict(zip(COUNTS, (n_words, inside, n_symbols, n_dup_lines, n_repeat, n_lines), strict=True))


def measured(docs: DataFrame, prefix: str = "") -> DataFrame:
    """docs with COUNTS of its text, their names with the prefix; no shuffle."""
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + c, T.LongType()) for c in COUNTS)])

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for b, e in common.slices(texts):
                found, part = counts(texts[b:e]), batch.slice(b, e - b)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], names=schema.names)

    return docs.mapInArrow(run, schema)


def ruled(rows: DataFrame, prefix: str = "") -> DataFrame:
    """rows of measured() with base_failed and soft_failed."""
    c = {name: F.col(prefix + name) for name in COUNTS}
    base = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    soft = [
        100 * c["n_symbols"] > MAX_SYMBOLS_PERCENT * c["n_words"],
        100 * c["n_dup_lines"] > MAX_DUP_PERCENT * c["n_lines"],
        ~c["word_chars"].between(MEAN_WORD[0] * c["n_words"], MEAN_WORD[1] * c["n_words"]),
    ]
    return rows.withColumn(prefix + "base_failed", base).withColumn(prefix + "soft_failed", sum((x.cast("int") for x in soft), F.lit(0)))


def host_rates(rows: DataFrame) -> tuple[DataFrame, int]:
    """(host, host_rate of the rows of ruled() by source; number of hosts)."""
    failed = (F.col("base_failed") | (F.col("soft_failed") > 0)).cast("long")
    hosts = common.written(rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(failed).alias("failed")), "hosts")
    a, b, n = beta_prior(hosts)
    return hosts.select(F.col("source").alias("host"), ((F.col("failed") + a) / (F.col("docs") + a + b)).alias("host_rate")), n


def with_verdict(rows: DataFrame, rates: DataFrame, hosts: int, prefix: str = "") -> DataFrame:
    """rows of ruled() with host_rate and kept."""
    named = rates.select(F.col("host").alias(prefix + "host"), F.col("host_rate").alias(prefix + "host_rate"))
    same = F.col("source").eqNullSafe(F.col(prefix + "host"))
    if hosts <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(named), same, "left")
    else:
        copies = named.withColumn(prefix + "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn(prefix + "dealt", F.pmod(F.xxhash64("doc_id", prefix + "n_words", prefix + "word_chars"), F.lit(SALTS)).cast("int"))
        joined = salted.join(copies, same & (F.col(prefix + "dealt") == F.col(prefix + "salt")), "left").drop(prefix + "dealt", prefix + "salt")
    allowed = F.when(F.col(prefix + "host_rate") > DOUBT, DOUBTED).otherwise(TRUSTED)
    return joined.withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & (F.col(prefix + "soft_failed") <= allowed)).drop(prefix + "host")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, source, COUNTS, base_failed, soft_failed, host_rate, kept of each document of docs (doc_id, source, text)."""
    rows = ruled(common.written(measured(_narrow(docs)).drop("text"), "quality"))
    return with_verdict(rows, *host_rates(rows))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that are kept.

    Texts are read twice (for the hosts, then for the rows) and not shuffled.
    """
    rates, hosts = host_rates(ruled(measured(_narrow(docs)).drop("text")))
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return with_verdict(ruled(measured(docs, prefix), prefix), rates, hosts, prefix).where(F.col(prefix + "kept")).select(*docs.columns)


def beta_prior(hosts: DataFrame) -> tuple[float, float, int]:
    """(alpha, beta, number of hosts): a beta distribution with the mean of all documents and the hosts' variance beyond chance.

    Three sums over hosts come to the driver.  Where hosts vary no more than
    chance, or there are none, the prior is as strong as a typical host.
    """
    got = hosts.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("docs").alias("docs"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("docs").cast("double") * F.col("docs")).alias("squares"),
        F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("docs")).alias("between"),
    ).first()
    if not got.docs:
        return 1.0, 1.0, 0
    mean = (got.failed + 0.5) / (got.docs + 1)
    typical = max(1.0, got.docs / got.n)
    strength = typical
    spread = got.docs - got.squares / got.docs
    if got.n > 1 and spread > 0:
        beyond = (got.between - got.failed * got.failed / got.docs - (got.n - 1) * mean * (1 - mean)) / spread
        if beyond > 0:
            strength = min(max(mean * (1 - mean) / beyond - 1, 1.0), 100 * typical)
    return mean * strength, (1 - mean) * strength, got.n


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "soft_failed", F.round("host_rate", 9).alias("host_rate")
    )


ORACLE_SQL = f"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), tokens AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
    SELECT doc_id, i, concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER in_doc" for k in range(1, WINDOW))}) AS gram, lead(i, {WINDOW - 1}) OVER in_doc AS last
    FROM tokens WINDOW in_doc AS (PARTITION BY doc_id ORDER BY i)
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams WHERE last IS NOT NULL) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range({WINDOW}) r(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), counted AS (
    SELECT words.doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0)::BIGINT AS n_lines
    FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), ruled AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
           ((100 * n_symbols > {MAX_SYMBOLS_PERCENT} * n_words)::INTEGER + (100 * n_dup_lines > {MAX_DUP_PERCENT} * n_lines)::INTEGER
            + (word_chars NOT BETWEEN {MEAN_WORD[0]} * n_words AND {MEAN_WORD[1]} * n_words)::INTEGER) AS soft_failed
    FROM counted
), hosts AS (
    SELECT source, count(*)::DOUBLE AS docs, sum((base_failed OR soft_failed > 0)::INTEGER)::DOUBLE AS failed FROM ruled GROUP BY source
), sums AS (
    SELECT count(*) AS n, sum(docs) AS docs, sum(failed) AS failed, sum(docs * docs) AS squares, sum(failed * failed / docs) AS between_, (sum(failed) + 0.5) / (sum(docs) + 1) AS mean FROM hosts
), beyond AS (
    SELECT *, greatest(1.0, docs / n) AS typical,
           CASE WHEN n > 1 AND docs - squares / docs > 0 THEN (between_ - failed * failed / docs - (n - 1) * mean * (1 - mean)) / (docs - squares / docs) ELSE 0 END AS beyond FROM sums
), prior AS (
    SELECT mean, CASE WHEN beyond > 0 THEN least(greatest(mean * (1 - mean) / beyond - 1, 1.0), 100 * typical) ELSE typical END AS strength FROM beyond
), rates AS (
    SELECT source, (failed + mean * strength) / (docs + mean * strength + (1 - mean) * strength) AS host_rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND soft_failed <= CASE WHEN host_rate > {DOUBT} THEN {DOUBTED} ELSE {TRUSTED} END AS kept,
       soft_failed, round(host_rate, 9) AS host_rate
FROM ruled JOIN rates ON ruled.source IS NOT DISTINCT FROM rates.source
"""
