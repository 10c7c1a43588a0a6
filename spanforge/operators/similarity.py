"""Joins of strings that contain one another or share most of their n-grams, without pairing everything with everything."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V
from spanforge.sources.staging import staged

#: Lengths of anchors, ascending: a string has an anchor of the greatest length that it holds.
ANCHORS = (1, 2, 4, 8)
#: Strings of a key up to which each is compared with each.
FEW = 256
#: Words of 64 bits in the bitmap of a set.
WORDS = 8
#: Tokens of a join's left side (about 2.5 letters each) up to which its rows are broadcast.
MOST_TOKENS = 200_000


def _anchor_length(n: Column) -> Column:
    out = F.lit(0)
    for k in ANCHORS:
        out = F.when(n >= k, k).otherwise(out)
    return out


def _grams(c: str, k: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (k - 1)), lambda i: F.substring(F.col(c), i, F.lit(k))))


def contained_pairs(a: DataFrame, b: DataFrame, key: str, least_ratio: float = V.LEAST_RATIO) -> DataFrame:
    """Pairs (key, a, b, ratio) of distinct strings of a (key, letters) and b (key, letters) of which one holds the other, with a ratio of lengths of least_ratio or more.

    In keys of at most FEW strings each is compared with each; others go through
    an index (_anchored_pairs).  Both keep work to the strings, not their square.
    """
    side = lambda rows, n: rows.where("letters <> ''").select(F.col(key).alias("_k"), F.lit(n).alias("_side"), "letters")
    rows = side(a, 0).unionByName(side(b, 1))
    many = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select("_k")
    few = rows.join(many, "_k", "left_anti")
    n, m = F.length("a"), F.length("b")
    close = (F.least(n, m) >= F.ceil(F.greatest(n, m) * least_ratio)) & F.when(n >= m, F.contains("a", "b")).otherwise(F.contains("b", "a"))
    left, right = few.where("_side = 0").select("_k", F.col("letters").alias("a")), few.where("_side = 1").select(F.col("_k").alias("_ok"), F.col("letters").alias("b"))
    each = left.join(right, (F.col("_k") == F.col("_ok")) & close).select(F.col("_k").alias(key), "a", "b", (F.least(n, m) / F.greatest(n, m)).alias("ratio"))
    return each.unionByName(_anchored_pairs(rows.join(many, "_k", "left_semi"), key, least_ratio)).distinct()


def _anchored_pairs(rows: DataFrame, key: str, least_ratio: float) -> DataFrame:
    """contained_pairs() of rows (_k, _side, letters), without pairing everything in a key.

    An index of containment: each string has one anchor, the rarest of its k-grams
    within its key, k being the greatest of ANCHORS that it is long enough for.  A
    string that holds another has that one's anchor among its own k-grams, of
    which it gives those of the lengths that a shorter string in the ratio can
    have.  Only strings that meet at an anchor are compared, so work follows the
    letters and what is alike, not the pairs of a key.
    """
    shortest = F.ceil(F.length("letters") * least_ratio)
    of_length = [F.when((F.lit(k) >= _anchor_length(shortest)) & (F.lit(k) <= _anchor_length(F.length("letters"))), _grams("letters", k)).otherwise(F.array().cast("array<string>")) for k in ANCHORS]
    grams = rows.select("_k", "_side", "letters", F.explode(F.concat(*of_length)).alias("_gram"))
    own = grams.where(F.length("_gram") == _anchor_length(F.length("letters")))
    often = own.groupBy("_k", "_gram").agg(F.count(F.lit(1)).alias("_n"))
    anchors = own.join(often, ["_k", "_gram"]).groupBy("_k", "_side", "letters").agg(F.min(F.struct("_n", "_gram")).alias("_a"))
    held = anchors.select(F.col("_k").alias("_ok"), F.col("_side").alias("_other"), F.col("letters").alias("_part"), F.col("_a._gram").alias("_at"))
    meets = (F.col("_k") == F.col("_ok")) & (F.col("_gram") == F.col("_at")) & (F.col("_side") != F.col("_other"))
    met = grams.join(held, meets & (F.length("_part") >= shortest) & (F.length("_part") <= F.length("letters")) & F.contains("letters", "_part"))
    first = F.col("_side") == 0
    ratio = F.length("_part") / F.length("letters")
    return met.select(F.col("_k").alias(key), F.when(first, F.col("letters")).otherwise(F.col("_part")).alias("a"), F.when(first, F.col("_part")).otherwise(F.col("letters")).alias("b"), ratio.alias("ratio"))


def gram_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the distinct grams of texts of ASCII letters and digits, sorted."""
    digit = np.zeros(128, np.int64)
    digit[[ord(c) for c in V.GRAM_LETTERS]] = np.arange(len(V.GRAM_LETTERS))
    at = digit[np.frombuffer("".join(texts).encode(), np.uint8)]
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes = np.zeros(max(0, len(at) - V.GRAM + 1), np.int64)
    for k in range(V.GRAM):
        codes = codes * len(V.GRAM_LETTERS) + at[k : k + len(codes)]
    whole = of[: len(codes)] == of[V.GRAM - 1 :][: len(codes)]
    return np.divmod(np.unique(of[: len(codes)][whole] * V.GRAM_CODES + codes[whole]), V.GRAM_CODES)


def _often(rows: DataFrame, c: str) -> np.ndarray:
    """How many strings have each gram: a table of GRAM_CODES numbers, whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(V.GRAM_CODES, np.int64)
        for batch in batches:
            total += np.bincount(gram_sets(batch.column(0).to_pylist())[1], minlength=V.GRAM_CODES)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["code", "n"])

    counted = rows.select(c).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(V.GRAM_CODES, np.int64)
    out[counted["code"].to_numpy()] = counted["n"].to_numpy()
    return out


def _classes(least: float) -> np.ndarray:
    """The least size of each class of sizes: sets in a ratio of least or more are of one class or of neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= V.GRAM_CODES:
        bounds.append(int(bounds[-1] / least + 1e-6) + 1)
    return np.array(bounds)


def _signed(rows: DataFrame, c: str, least: float, often: np.ndarray | None = None) -> DataFrame:
    """rows with, of the grams of a column of letters, their number, the class of it, themselves, and a bitmap of them in words; given how often grams are, also as tokens those n - ceil(least * n) + 1 that come first, the rarest first; names begin with the column's."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), f"{c}_n int", f"{c}_class int", f"{c}_grams array<int>", *(f"{c}_w{i} long" for i in range(WORDS)), *([f"{c}_tokens array<int>"] if often is not None else [])])
    names = [x.split(" ")[0] for x in schema.split(", ")][len(rows.columns) :]
    place, bounds = rows.columns.index(c), _classes(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            of, codes = gram_sets(texts)
            size = np.bincount(of, minlength=len(texts))
            bits = np.zeros((len(texts), 64 * WORDS), bool)
            bits[of, (codes * 0x9E3779B1 & 0xFFFFFFFF) >> 8 & (64 * WORDS - 1)] = True
            words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(codes.astype(np.int32)))
            made = [pa.array(size.astype(np.int32)), pa.array((np.searchsorted(bounds, size, "right") - 1).astype(np.int32)), listed, *(pa.array(words[:, i]) for i in range(WORDS))]
            if often is not None:
                order = np.lexsort((codes, often[codes], of))
                rank = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                some = rank <= (size - np.ceil(least * size - 1e-9).astype(np.int64))[of]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of[some], minlength=len(texts)))])
                made.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(codes[order][some].astype(np.int32))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    return rows.mapInArrow(run, schema)


def similar_pairs(a: DataFrame, b: DataFrame, key: str | None = None, least: float = V.LEAST_JACCARD) -> DataFrame:
    """Rows of a and b (a column a and a column b of letters and digits, GRAM at least; others with names of their own) whose trigram sets have a Jaccard of least or more, with jaccard; only those of equal key, if there is one.

    A set-similarity join.  Sets that are alike have sizes in the ratio, so a set
    meets those of its class of sizes and of the two beside it (of its key, if
    there is one); of what meets, pairs go on whose bitmaps differ in no more bits
    than the sets may in grams, and those are confirmed on their sets.  Letters
    have so few trigrams that bitmaps of a class cost less than what meets at
    shared grams.  Rows are joined as they are, once (the other side in three
    classes), and nothing of them is made per gram.

    b is read once.  Without a key a is broadcast, if it has at most MOST_TOKENS
    tokens (some 2.5 letters each); beyond that both sides are shuffled by token,
    as _by_tokens() has it.
    """
    n, m = F.col("a_n"), F.col("b_n")
    differ = sum((F.bit_count(F.col(f"a_w{i}").bitwiseXOR(F.col(f"b_w{i}"))) for i in range(WORDS)), F.lit(0))
    alike = (F.least(n, m) >= F.greatest(n, m) * least - 1e-9) & (differ <= (n + m) * ((1 - least) / (1 + least)) + 1e-9)
    beside = lambda rows, c: rows.withColumn("_class", F.explode(F.array(*(F.col(f"{c}_class") + i for i in (-1, 0, 1)))))
    if key:
        right = beside(_signed(b, "b", least).withColumnRenamed(key, "_key"), "b")
        met = _signed(a, "a", least).join(right, (F.col("_key") == F.col(key)) & (F.col("_class") == F.col("a_class")) & alike)
    else:
        a = staged(a, "left")
        left = staged(_signed(a, "a", least), "signed")
        small = left.select(F.sum(n - F.ceil(n * least - 1e-9) + 1).alias("n")).first()["n"] or 0
        if small <= MOST_TOKENS:
            met = _signed(b, "b", least).join(F.broadcast(beside(left, "a")), (F.col("_class") == F.col("b_class")) & alike)
        else:
            met = _by_tokens(a, b, least, alike)
    # Exploded, as a filter on a plain column would be moved in front of the join's own, dear before cheap, and make its code too long to be compiled.
    common = F.size(F.array_intersect("a_grams", "b_grams"))
    scored = met.select("*", F.explode(F.array(common)).alias("_common")).withColumn("jaccard", F.col("_common") / (n + m - F.col("_common"))).where(F.col("jaccard") >= least)
    return scored.select(*a.columns, *(c for c in b.columns if c != key), "jaccard")


def _by_tokens(a: DataFrame, b: DataFrame, least: float, alike: Column) -> DataFrame:
    """Pairs of a and b that meet at a token, once each, and may be alike.

    Grams are put in one order, the rarest in a first; two sets that are alike
    share a gram among the first of both (prefixes), so the tokens there are what
    is joined.  Of what meets, pairs go on whose places of the shared gram leave
    enough in common, and for which this gram is their first one in common.
    Neither side goes through the driver, only a table of GRAM_CODES counts.
    """
    often = _often(a, "a")
    left = _signed(a, "a", least, often).select("*", F.posexplode("a_tokens").alias("a_at", "token"))
    right = _signed(b, "b", least, often).select("*", F.posexplode("b_tokens").alias("b_at", "_token"))
    n, m = F.col("a_n"), F.col("b_n")
    enough = F.least(n - F.col("a_at"), m - F.col("b_at")) >= (n + m) * (least / (1 + least)) - 1e-9
    first = F.size(F.array_intersect(F.slice("a_tokens", F.lit(1), F.col("a_at")), F.slice("b_tokens", F.lit(1), F.col("b_at")))) == 0
    return right.join(left, (F.col("_token") == F.col("token")) & enough & alike).select("*", F.explode(F.array(first)).alias("_first")).where("_first")
