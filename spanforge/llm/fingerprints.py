"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its word n-grams, padded at the front so
that n words give n terms, each weighted by how often it occurs.  Each of
SAMPLES draws picks one term with its quantised weight such that two documents
pick the same with a probability equal to their generalised Jaccard similarity
(sum of minima over sum of maxima of the weights).  For term x of weight w, with
r and c from Gamma(2, 1) and b uniform in [0, 1), fixed by x and the draw:

    t = floor(ln w / r + b),   ln a = ln c - r (t - b) - r,

and the term of the least ln a is drawn, together with its t.  The signature
keeps 16 bits of a hash of (term, t) for each draw; the likeness of two
signatures is the share of equal draws.

The gamma and uniform variates come from fixed tables of ROWS x SAMPLES values,
indexed by separate bits of the term's hash, so two terms share all of their
variates with a chance of ROWS^-2.  Almost all terms have weight 1, for which
ln a is the sum of two table rows.

Defined cases: a null text is empty; a text without words has the empty
signature's fixed value, which is equal among such texts and has no likeness to
others; of terms with equal ln a the one of the least hash is drawn; a very long
text is drawn from whole, some of its terms at a time; a table of one document
has itself as its next; equal doc_ids follow in the order of a digest of their
text, then of the text; null doc_ids come first; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm import textbatch as tb

SAMPLES = 64
GRAM = 3
TABLE_BITS = 14
SEED = 4
#: Ids sampled for each cut point between ranges.
CUT_SAMPLE = 60
NO_TERMS = "0" * (4 * SAMPLES)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln c by one part of a hash; r and b by another."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    size = (1 << TABLE_BITS, SAMPLES)
    return (
        np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32),
        rng.gamma(2.0, 1.0, size).astype(np.float32),
        rng.random(size).astype(np.float32),
    )


@lru_cache(1)
def _single() -> np.ndarray:
    """What a term of weight 1 has besides ln c: t is 0, so r b - r."""
    _, r, b = _tables()
    return r * (b - 1)


def terms(texts: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight of each distinct term of each text; bounds of each text's terms)."""
    codes, bounds = tb.pack(texts)
    begin, end, of_words = tb.words(codes, bounds)
    hashes = tb.span_hashes(codes, begin, end)
    of = tb.owner(of_words)
    place = np.arange(len(hashes)) - of_words[:-1][of]
    total = np.zeros(len(hashes), np.uint64)
    for back in range(gram):
        before = np.zeros(len(hashes), np.uint64)
        before[back:] = hashes[: len(hashes) - back]
        before[place < back] = 0
        total = tb.mixed(total) + before
    total = tb.mixed(total)
    order = np.lexsort((total, of))
    total, of = total[order], of[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return total[at], np.diff(np.append(at, len(total))), np.searchsorted(of[at], np.arange(len(texts) + 1))


def signatures(texts: list[str], gram: int = GRAM, block: int = 1 << 13) -> np.ndarray:
    """A row of SAMPLES 16-bit values for each text; zeros for a text without terms."""
    hashes, weights, bounds = terms(texts, gram)
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    ln_c, r, b = _tables()
    single = _single()
    mask = np.uint64((1 << TABLE_BITS) - 1)
    row_c, row_r = (hashes & mask).astype(np.int64), (hashes >> np.uint64(TABLE_BITS) & mask).astype(np.int64)
    many = weights > 1
    best = np.full((len(texts), SAMPLES), np.inf, np.float32)
    drawn = np.zeros((len(texts), SAMPLES), np.int64)
    step = np.zeros((len(texts), SAMPLES), np.int32)
    sizes = np.diff(bounds)
    first = 0
    while first < len(texts):  # whole texts, about block terms at a time; a long text takes several rounds
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + block, "right")) - 1)
        for low in range(int(bounds[first]), int(bounds[last]), block if last == first + 1 else max(block, int(bounds[last] - bounds[first]))):
            high = min(int(bounds[last]), low + block) if last == first + 1 else int(bounds[last])
            value = ln_c[row_c[low:high]]
            value += single[row_r[low:high]]
            heavy = np.flatnonzero(many[low:high])
            times = np.zeros((len(heavy), SAMPLES), np.int32)
            if len(heavy):
                rr, bb = r[row_r[low + heavy]], b[row_r[low + heavy]]
                t = np.floor(np.log(weights[low + heavy]).astype(np.float32)[:, None] / rr + bb)
                times[:] = t
                value[heavy] = ln_c[row_c[low + heavy]] - rr * (t - bb) - rr
            which = np.flatnonzero(sizes[first:last]) + first
            starts = np.maximum(bounds[which], low) - low
            least = np.minimum.reduceat(value, starts, axis=0)
            length = np.diff(np.append(starts, high - low))
            hit, draw = np.nonzero(value == np.repeat(least, length, axis=0))
            text = np.repeat(which, length)[hit]
            jump = np.full(high - low, -1, np.int64)
            jump[heavy] = np.arange(len(heavy))
            t = np.where(jump[hit] >= 0, times[jump[hit], draw] if len(heavy) else 0, 0)
            better = value[hit, draw] < best[text, draw]
            hit, draw, text, t = hit[better], draw[better], text[better], t[better]
            best[text[::-1], draw[::-1]] = value[hit[::-1], draw[::-1]]
            drawn[text[::-1], draw[::-1]] = low + hit[::-1]
            step[text[::-1], draw[::-1]] = t[::-1]
        first = last
    full = sizes > 0
    kept = tb.mixed(hashes[drawn[full]] + step[full].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    out[full] = np.maximum(kept.astype(np.uint16), 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal draws of each row; two texts without terms are alike."""
    return np.where(~a.any(1) & ~b.any(1), 1.0, ((a == b) & (a != 0)).mean(1))


def edited(text: str, following: str) -> str:
    """text with its last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows part, rank, doc_id, text, so dealt that each part holds a run of the ascending order and, last, the row after it.

    One shuffle of the texts.  Parts are ranges between cut points, which come
    from a sample of (doc_id, digest of the text) and matter for balance only, so
    rows of one doc_id, or without one, are parted too unless their texts are
    equal.  The first row of each part is added to the part before it (of the
    first part, to the last).  The driver and the broadcast hold one row for each
    part.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    parts = common.shuffle_partitions(spark)
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    pair = np.dtype([("k", np.int64), ("d", np.int64)])
    drawn = F.rand(SEED) < min(1.0, CUT_SAMPLE * parts / max(1, docs.count()))
    sample = np.sort(np.array([(r.k, r.digest) for r in rows.select(key.alias("k"), "digest").where(drawn).collect()], pair))
    cuts = np.unique(sample[[len(sample) * i // parts for i in range(1, parts)]]) if len(sample) else sample

    @F.pandas_udf("int")
    def place(k: pd.Series, digest: pd.Series) -> pd.Series:
        both = np.empty(len(k), pair)
        both["k"], both["d"] = k.to_numpy(), digest.to_numpy()
        return pd.Series(np.searchsorted(cuts, both, "right").astype(np.int32))

    rows = rows.withColumn("part", place(key, "digest"))
    first = F.min(F.struct(key.alias("k"), "digest")).alias("first")
    order = sorted((r.part, *r["first"]) for r in rows.groupBy("part").agg(first).collect())
    if not order:
        return rows.select("part", F.lit(0).alias("rank"), "doc_id", "digest", "text")
    to = spark.createDataFrame([(k, d, order[i - 1][0]) for i, (_, k, d) in enumerate(order)], "k long, d long, to int")
    head = (
        rows.select("doc_id", "digest", "text").join(F.broadcast(to), (key == F.col("k")) & (F.col("digest") == F.col("d"))).groupBy("to", "doc_id", "digest").agg(F.min("text").alias("text"))
    ).select(F.col("to").alias("part"), F.lit(1).alias("rank"), "doc_id", "digest", "text")
    both = rows.select("part", F.lit(0).alias("rank"), "doc_id", "digest", "text").union(head)
    return both.repartitionById(parts, "part").sortWithinPartitions("part", "rank", "doc_id", "digest", "text").drop("digest")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document of docs (doc_id, text)."""

    def shown(x: np.ndarray) -> list[str]:
        raw, wide = x.astype(">u2").tobytes().hex(), 4 * SAMPLES
        return [raw[i : i + wide] for i in range(0, len(raw), wide)]

    def block(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
        texts = [r[3] for r in rows]
        changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        chain = all(f is t for f, t in zip(following, texts[1:], strict=False))
        own = signatures([*texts, following[-1]])
        after = own[1:] if chain else signatures(following)
        own, other = own[:-1], signatures(changed)
        columns = [
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(shown(own)),
            pa.array(shown(other)),
            pa.array(likeness(own, other)),
            pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if row[1] == 1:  # the row after this part's last
                    if held:
                        yield block(held, [*(r[3] for r in held[1:]), row[3]])
                    held, size = [], 0
                    continue
                if held and size > 1 << 19:
                    yield block(held, [*(r[3] for r in held[1:]), row[3]])
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            raise ValueError("a part came without the row that follows it")

    return with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
