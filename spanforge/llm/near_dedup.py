"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives, for each document, the size of its set of word
   shingles, a 128-bit key of the set, the BITS low bits of MINIMA minima packed
   into longs, and a hash of each band of ROWS full minima.  No shingle leaves
   the task.
2. Documents with equal sets are one class, represented by the smallest doc_id.
   All else works on representatives, so copies cost one row each.  Copies find
   their representative through salted keys, so a group of copies is dealt over
   many tasks however large it is.
3. Representatives that share a band are candidates.  Within a band bucket each
   member is paired with one hub (the smallest id), not with all members.  Pairs
   whose sizes or whose collision-corrected estimate (bit counts of the packed
   signatures) rule the similarity out are dropped.
4. Pairs left are confirmed on full sets: the texts of just these documents are
   shingled again and intersected.
5. Confirmed pairs give components (alternating large and small stars, whose
   rounds grow with the logarithm of a component's size).
6. Where a bucket still holds several components, the members outside its
   largest one are paired with the most alike of a few sampled members of that
   one, for ROUNDS rounds, which joins most of what belongs together.
7. The rest, exactly: outside members that still have a possible partner in
   another component of a bucket are compared with all of them, with full sets
   within the join, so that only links come out of it.  In a bucket of more than
   DIRECT members that would be too many pairs; there each full set gives its
   prefix, the shingles that are rarest over all these sets.  Of two linked sets
   the first shingle that they share is among the first 8.2 % of the smaller and
   15 % of the larger one, so only members of different components that share one
   there, with enough shingles after it, are compared.  Pairs within a component
   cannot change the result, so no candidate pair that could join two components
   is left unchecked.

A pair at the threshold 0.85 shares no band with a chance of 4e-7, and falls
under the estimate's floor with a chance of about 1e-7.

Joins on band buckets, ids and set keys are plain equi-joins, which adaptive
execution splits where a bucket or hub is hot; counts and minima are partial
aggregates.  Loops cut their lineage with tables in the shared folder.

Defined cases: A-Z is lower-cased; a text with fewer words than a shingle is one
shingle; null texts and texts without words have an empty set and are linked
with nothing; a null doc_id is linked with nothing and has no component (kept);
rows that repeat a doc_id are one document (the union of their links); of equal
candidates the smaller id goes first, which no result depends on; a very long
text is one set, handled whole in one task; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm import textbatch as tb

SHINGLE = 5
#: Linked if DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 85, 100
MINIMA, ROWS, BANDS, BITS = 128, 5, 25, 2
#: How far under the threshold an estimate may be and still be confirmed: over five standard deviations.
SLACK = 0.2
#: Rounds in which members outside a bucket's largest component are paired with sampled members of it; samples a bucket, pairs a member.
ROUNDS, SAMPLED, BEST = 2, 4, 4
#: Members a bucket up to which all pairs are looked at; slots in which shingles of larger ones are counted.
DIRECT, SLOTS = 128, 1 << 18
#: Bits of the broadcast bitmap, 16 MB at most, in blocks as Spark builds them.
FLAG_BITS, _BLOCK = 1 << 27, 1 << 15
#: Copies of a set are dealt over salts, one for each SALT_ROWS documents, LEAST_SALTS at least.
LEAST_SALTS, SALT_ROWS = 32, 100_000
_LANES = 64 // BITS
SIGNATURE = [f"s{i}" for i in range(MINIMA // _LANES)]


def sets(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, ascending within the text; their bounds)."""
    codes, bounds = tb.pack(texts)
    codes = tb.folded(codes)
    begin, end, of_words = tb.words(codes, bounds)
    hashes, of = tb.windows(tb.span_hashes(codes, begin, end), of_words, shingle)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.searchsorted(of, np.arange(len(texts) + 1))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = tb.mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
    return (seeds[:MINIMA] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[MINIMA:] >> np.uint64(32)).astype(np.uint32)


def minima(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MINIMA minima of each set that is not empty, as 32-bit values, one row for each set."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((MINIMA, len(full)), np.uint32)
    if len(full):
        low, starts = (hashes >> np.uint64(32)).astype(np.uint32), bounds[:-1][full]
        for i, (a, b) in enumerate(zip(*_multipliers(), strict=True)):
            x = low * a + b
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            out[i] = np.minimum.reduceat(x, starts)
    return out.T


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, key_a, key_b, the packed signature and bands of each document; no shuffle."""

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for b, e in common.slices(texts):
                hashes, bounds = sets(texts[b:e], shingle)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                least = minima(hashes, bounds)
                lanes = (tb.mixed(least) & np.uint64((1 << BITS) - 1)).reshape(len(full), len(SIGNATURE), _LANES)
                packed = np.zeros((e - b, len(SIGNATURE)), np.uint64)
                packed[full] = (lanes << (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
                band = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], len(full), 0)
                for r in range(ROWS):
                    band = tb.mixed(band * np.uint64(0x9E3779B97F4A7C15) + least[:, r : BANDS * ROWS : ROWS])
                twice = [tb.bounds_of(tb.mixed(hashes ^ np.uint64(c)))[bounds].view(np.uint64) for c in (0x1234567, 0x89ABCDE)]
                columns = [
                    batch.column(0).slice(b, e - b),
                    pa.array(size.astype(np.int64)),
                    *(pa.array(signed(np.diff(x))) for x in twice),
                    *(pa.array(signed(packed[:, i])) for i in range(len(SIGNATURE))),
                    pa.ListArray.from_arrays(pa.array(tb.bounds_of((size > 0) * BANDS).astype(np.int32)), pa.array(signed(band.reshape(-1)))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "key_a", "key_b", *SIGNATURE, "bands"])

    kinds = "doc_id long, n_shingles long, key_a long, key_b long, " + ", ".join(f"{s} long" for s in SIGNATURE) + ", bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its full set as an array; no shuffle."""

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for b, e in common.slices(texts, 1 << 19):
                hashes, bounds = sets(texts[b:e], shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b, e - b), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(hashes)))], names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _estimate(a: str, b: str):
    """Collision-corrected similarity of two packed signatures: a lane agrees by chance once in 2^BITS."""
    lanes = int("01" * _LANES, 2)  # the low bit of each two-bit lane
    differ = F.lit(0)
    for s in SIGNATURE:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(lanes)))
    chance = 1.0 / (1 << BITS)
    return ((1.0 - differ / float(MINIMA)) - chance) / (1.0 - chance)


def _possible(a: str, b: str):
    """Whether sizes and the estimate leave the pair of structs a, b in the running."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)) & (_estimate(a, b) >= NUMERATOR / DENOMINATOR - SLACK)


def flagged(rows: DataFrame, ids: DataFrame, flag: str, column: str = "doc_id") -> DataFrame:
    """rows with a flag: false only where the column is surely none of ids (id, not null).

    A bitmap of id hashes is broadcast, its size bounded by FLAG_BITS whatever
    the number of ids; a fuller bitmap lets more rows pass and loses none.  It
    spares a shuffle of texts whose ids are not asked for.
    """
    bits, wanted = FLAG_BITS, 32 * max(1, ids.count())
    while bits > _BLOCK and bits >= wanted:
        bits //= 2
    prefix = common.free_prefix(rows)
    place, block, bitmap, byte = (prefix + c for c in ("place", "block", "bitmap", "byte"))
    placed = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    blocks = ids.select(placed("id").alias("p")).groupBy(F.floor(F.col("p") / _BLOCK).alias(block)).agg(F.bitmap_construct_agg(F.col("p") % _BLOCK).alias(bitmap))
    marked = rows.withColumn(place, placed(column)).join(F.broadcast(blocks), F.floor(F.col(place) / _BLOCK) == F.col(block), "left")
    at = F.col(place) % _BLOCK
    held = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.expr(f"shiftright({byte}, cast({place} % 8 as int)) & 1") == 1
    return marked.withColumn(byte, held).withColumn(flag, F.coalesce(bit, F.lit(False)) & F.col(column).isNotNull()).drop(place, block, bitmap, byte)


def joined_to_hubs(pairs: DataFrame, rows: DataFrame, hub: str, member: str) -> DataFrame:
    """pairs joined with rows on hub, which a third of all pairs may share.

    Pairs are dealt by hub and a salt of the member; only the salts that occur
    with a hub fetch a copy of its row.
    """
    dealt = pairs.withColumn("_salt", F.pmod(F.xxhash64(member), F.lit(max(LEAST_SALTS, pairs.count() // SALT_ROWS))))
    copies = dealt.select(hub, "_salt").distinct().join(rows, hub)
    return dealt.join(copies, [hub, "_salt"]).drop("_salt")


def needed_sets(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """Full sets (doc_id, shingles) of the documents in pairs (a, b), and of the few more that their bitmap lets pass."""
    ids = common.written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "needed")
    rows = flagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "asked")
    out = common.written(shingle_sets(rows.where("asked"), shingle), "sets")
    common.dropped(ids)
    return out


def _linked_sets(x: str, y: str):
    inter = F.size(F.array_intersect(x, y))
    return DENOMINATOR * inter >= NUMERATOR * (F.size(x) + F.size(y) - inter)


def _confirmed_on(full: DataFrame, pairs: DataFrame) -> DataFrame:
    both = joined_to_hubs(pairs, full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b", "a")
    both = both.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    out = common.written(both.where(_linked_sets("x", "y")).select("a", "b").distinct(), "links")
    common.dropped(full, pairs)
    return out


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b; a written table, which is deleted) whose full sets reach the threshold."""
    return _confirmed_on(needed_sets(pairs, docs, shingle), pairs)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in links (a, b): the smallest id reachable, by alternating stars."""
    stars = common.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
        large = common.written(both.join(least, F.col("u") == F.col("of")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        down = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
        near = large.join(down, F.col("u") == F.col("of"))
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("of", "m")).distinct()
        new = common.written(small, "stars")
        same = new.count() == stars.count() and new.exceptAll(stars).isEmpty()
        common.dropped(stars, large)
        stars = new
        if same:
            out = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
            out._spanforge_path = stars._spanforge_path
            return out


def _contested(members: DataFrame, features: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: bucket, rep, f, part, top (the largest component there)."""
    placed = members.join(found, F.col("rep") == F.col("id"), "left").select("bucket", "rep", F.coalesce("component", "rep").alias("part"))
    sizes = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("size"))
    top = sizes.groupBy("bucket").agg(F.max(F.struct("size", "part")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("bucket", F.col("top.part").alias("top"))
    return placed.join(top, "bucket").join(features, "rep").select("bucket", "rep", "f", "part", "top")


def _sides(contested: DataFrame) -> tuple[DataFrame, DataFrame]:
    outside = contested.where("part <> top").select(F.col("bucket").alias("of"), F.col("rep").alias("a"), F.col("part").alias("part_a"), F.col("f").alias("fa"))
    return outside, contested.select("bucket", F.col("rep").alias("b"), F.col("part").alias("part_b"), F.col("f").alias("fb"), "top")


def _sampled(contested: DataFrame, round_: int) -> DataFrame:
    """Pairs (a, b): each outside member with the BEST by estimate among SAMPLED members of the largest component in each of its buckets."""
    outside, others = _sides(contested)
    turn = F.xxhash64("b", F.lit(round_))
    picks = others.where("part_b = top").groupBy("bucket", F.pmod(turn, F.lit(SAMPLED)).alias("slot")).agg(F.min_by(F.struct("b", "fb"), turn).alias("pick")).select("bucket", "pick.*")
    pairs = outside.join(picks, (F.col("of") == F.col("bucket")) & _possible("fa", "fb"))
    rank = F.struct((-_estimate("fa", "fb")).alias("less"), "b")
    best = F.slice(F.array_sort(F.collect_set(rank)), 1, BEST)
    return pairs.groupBy("a").agg(best.alias("best")).select("a", F.explode("best.b").alias("b"))


def _exhaustive(contested: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """Links (a, b) between members of different components of a bucket, every pair looked at.

    Only outside members with a possible partner, and the buckets they are in,
    get their full sets; pairs are confirmed within the join, so what comes out
    is links.
    """
    outside, others = _sides(contested)
    apart = (F.col("of") == F.col("bucket")) & (F.col("part_a") != F.col("part_b")) & ((F.col("part_b") == F.col("top")) | (F.col("a") < F.col("b")))
    live = common.written(outside.join(others, apart & _possible("fa", "fb"), "left_semi"), "live")
    others = common.written(others.join(live.select("of").distinct(), F.col("bucket") == F.col("of"), "left_semi"), "others")
    full = needed_sets(live.select("a", F.col("a").alias("b")).union(others.select(F.col("b").alias("a"), "b")), docs, shingle)
    left = live.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    right = others.join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    out = common.written(left.join(right, apart & _possible("fa", "fb") & _linked_sets("x", "y")).select("a", "b").distinct(), "links")
    common.dropped(full, live, others)
    return out


def _rare_prefixes(full: DataFrame) -> DataFrame:
    """doc_id, n, place, token: of each set of n shingles those n - ceil(threshold * n) + 1 that come first by their number, then by hash.

    Numbers are counted in SLOTS slots, whose table goes to the tasks; slots that
    several shingles share make the order less apt, never the result wrong.
    """
    counted = full.select(F.explode("shingles").alias("h")).groupBy(F.pmod("h", F.lit(SLOTS)).alias("slot")).count().toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[counted["slot"].to_numpy()] = counted["count"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(1).value_lengths().to_numpy().astype(np.int64)
            hashes = batch.column(1).flatten().to_numpy().view(np.uint64)
            of = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((hashes, often[(hashes % np.uint64(SLOTS)).astype(np.int64)], of))
            place = np.arange(len(hashes)) - np.repeat(tb.bounds_of(size)[:-1], size)
            first = place <= (size - -(-NUMERATOR * size // DENOMINATOR))[of]
            columns = [batch.column(0).take(pa.array(of[first])), pa.array(size[of][first]), pa.array(place[first]), pa.array(signed(hashes[order][first]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "place", "token"])

    return full.mapInArrow(run, "doc_id long, n long, place long, token long")


def _by_prefixes(contested: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """Links (a, b) between members of different components, those that are outside in a bucket against all.

    A linked pair has at least t / (1 + t) of the sum of its sizes in common (t
    the threshold), and all of that from its first common shingle on.  Of the
    smaller set that shingle is therefore within n - 2 t / (1 + t) n.  Two
    members that are both in their largest components meet in neither join.
    """
    members = contested.groupBy("rep", "f", "part").agg(F.max(F.col("part") != F.col("top")).alias("outside"))
    members = common.written(members, "prefix-members")
    full = needed_sets(members.select(F.col("rep").alias("a"), F.col("rep").alias("b")), docs, shingle)
    found = _rare_prefixes(full).join(members, (F.col("doc_id") == F.col("rep")) & (F.col("n") == F.col("f.n")))
    tokens = common.written(found.select("token", "rep", "f", "part", "outside", (F.col("n") - F.col("place")).alias("left")), "prefixes")
    mixed = tokens.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("token")
    tokens_mixed = common.written(tokens.join(mixed, "token", "left_semi"), "mixed")
    n, m, total = F.col("fa.n"), F.col("fb.n"), NUMERATOR + DENOMINATOR
    smaller = tokens_mixed.where(total * F.col("left") >= 2 * NUMERATOR * F.col("f.n")).select("token", F.col("rep").alias("a"), F.col("part").alias("part_a"), F.col("f").alias("fa"), F.col("left").alias("left_a"), "outside")
    larger = tokens_mixed.select(F.col("token").alias("of"), F.col("rep").alias("b"), F.col("part").alias("part_b"), F.col("f").alias("fb"), F.col("left").alias("left_b"), F.col("outside").alias("_outside"))
    apart = (F.col("token") == F.col("of")) & (F.col("part_a") != F.col("part_b")) & (n <= m)
    apart = apart & (total * F.least("left_a", "left_b") >= NUMERATOR * (n + m)) & _possible("fa", "fb")
    met = smaller.where("outside").join(larger, apart).select("a", "b").union(smaller.where("not outside").join(larger.where("_outside"), apart).select("a", "b"))
    pairs = common.written(met.distinct(), "pairs")
    common.dropped(tokens, tokens_mixed, members)
    return _confirmed_on(full, pairs)


def _rest(contested: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """Links (a, b) between members of different components of a bucket: directly in small buckets, through prefixes in large ones."""
    large = common.written(contested.groupBy("bucket").count().where(F.col("count") > DIRECT).select(F.col("bucket").alias("large")), "large")
    if large.isEmpty():
        common.dropped(large)
        return _exhaustive(contested, docs, shingle)
    in_large = F.col("bucket") == F.col("large")
    direct = _exhaustive(contested.join(large, in_large, "left_anti"), docs, shingle)
    other = _by_prefixes(contested.join(large, in_large, "left_semi"), docs, shingle)
    out = common.written(direct.union(other).distinct(), "links")
    common.dropped(large, direct, other)
    return out


def linked(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each document of docs (doc_id, text)."""
    signed_docs = common.written(signatures(docs, shingle), "signatures")
    known = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    key = ["key_a", "key_b", "n_shingles"]
    salts = max(LEAST_SALTS, signed_docs.count() // SALT_ROWS)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    salted = signed_docs.where(known).groupBy(*key, salt.alias("salt")).agg(F.min("doc_id").alias("rep"))
    least = salted.groupBy(*(F.col(c).alias(f"_{c}") for c in key)).agg(F.min("rep").alias("_rep"))
    by_set = common.written(salted.join(least, [F.col(c) == F.col(f"_{c}") for c in key]).select(*key, "salt", F.col("_rep").alias("rep")), "sets")
    same_set = [F.col(f"d.{c}") == F.col(f"s.{c}") for c in (*key, "salt")]
    is_rep = F.col("doc_id") == F.col("rep")
    classes = common.written(
        signed_docs.withColumn("salt", salt).alias("d").join(by_set.alias("s"), same_set, "left").select("doc_id", "d.n_shingles", "rep", *SIGNATURE, F.when(is_rep, F.col("bands")).alias("bands")),
        "classes",
    )
    reps = classes.where(is_rep).select("rep", F.col("n_shingles").alias("n"), *SIGNATURE, "bands").dropDuplicates(["rep", "n", *SIGNATURE])
    reps = common.written(reps, "representatives")
    common.dropped(signed_docs, by_set)
    of_id = classes.where(known).groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b <> most")
    repeated_ids = classes.join(of_id, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct()
    features = reps.select("rep", F.struct("n", *SIGNATURE).alias("f"))
    dealt = reps.select("rep", F.explode("bands").alias("bucket"))
    buckets = common.written(dealt.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    members = common.written(dealt.join(buckets, "bucket").select("bucket", "rep", "hub"), "members")

    hubs = common.written(members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), "hubs")
    both = joined_to_hubs(hubs, features.select(F.col("rep").alias("b"), F.col("f").alias("fb")), "b", "a")
    both = both.join(features.select(F.col("rep").alias("a"), F.col("f").alias("fa")), "a")
    first = common.written(both.where(_possible("fa", "fb")).select("a", "b").distinct(), "pairs")
    common.dropped(hubs)
    made = [confirmed(first, docs, shingle)]
    links = made[0].union(repeated_ids)
    found = components(links)
    for round_ in range(ROUNDS):
        contested = common.written(_contested(members, features, found), "contested")
        more = confirmed(common.written(_sampled(contested, round_), "pairs"), docs, shingle)
        common.dropped(contested)
        made.append(more)
        if more.isEmpty():
            break
        links = links.union(more)
        common.dropped(found)
        found = components(links)
    contested = common.written(_contested(members, features, found), "contested")
    more = _rest(contested, docs, shingle)
    if not more.isEmpty():
        common.dropped(found)
        found = components(links.union(more))
    common.dropped(contested, more, *made, members, buckets, reps)
    out = classes.join(found, F.col("rep") == F.col("id"), "left").withColumn("component_id", F.coalesce("component", "rep"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs, all columns as they are, one for each component: that of the smallest doc_id.

    Rows without a doc_id stay.  Of rows that repeat a doc_id that of the least
    text stays, of equal ones that of the least hash of all columns.  Columns may
    have any names and types.
    """
    verdicts = linked(docs.select("doc_id", "text"), shingle)
    prefix = common.free_prefix(docs)
    id_, n, flag, row = (prefix + c for c in ("id", "n", "flag", "row"))
    columns = [F.col(common.quoted(c)) for c in docs.columns]
    gone = common.written(verdicts.where(~F.col("kept")).select(F.col("doc_id").alias(id_)).distinct(), "gone")
    again = common.written(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(id_)).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(id_), "repeated")
    if not again.isEmpty():
        same = F.col("doc_id") == F.col(id_)
        order = F.struct("text", F.xxhash64(*(c.cast("string") for c in columns)))
        least = docs.join(again, same, "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*columns), order).alias(row))
        docs = docs.join(again, same, "left_anti").unionByName(least.select(f"{row}.*"))
    marked = flagged(docs, gone.select(F.col(id_).alias("id")), flag)
    asked = marked.where(F.col(flag)).drop(flag).join(gone, F.col("doc_id") == F.col(id_), "left_anti")
    return marked.where(~F.col(flag)).drop(flag).unionByName(asked).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
