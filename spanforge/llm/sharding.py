"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded digest and ranked; row r of n in its
source gets the fractional rank (2r - 1) / 2n.  All rows sorted by fractional
rank interleave the sources in proportion, so equal cuts of that order carry
the mixture of the whole and differ in count by one row at most.

No window runs over a whole source or the whole table.  Rows are dealt into
digest buckets (for the rank in a source) and into rank buckets (for the place
in the interleaved order) of a few thousand rows each; the bucket counts alone
are summed up in order, within chunks of buckets and over chunks.  A source with
a third of all rows is thus ranked by as many tasks as its buckets.

Defined cases: a null source is a source of its own; a null text has no bytes; a
very long text counts and is digested as a whole, and only its digest moves;
equal texts are rows like others, spread over the shards as their digests fall
(the law is `rows`, the strata are sources); equal doc_ids are ordered by the
digest of their text, and rows equal in both are interchangeable; an empty table
gives no rows; other columns of the input are not carried, so their names cannot
clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm import common

SHARDS = 24
SEED = "spanforge-9"
BUCKET_ROWS = 2048


def stratified_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
    total: int | None = None,
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot for each row of docs (doc_id, source, text).

    Two shuffles of narrow rows: by (source, digest bucket), then by rank bucket.
    """
    total = docs.count() if total is None else total
    buckets = max(1, -(-total // bucket_rows))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        common.crc32(text).alias("text_crc32"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(text))).alias("digest"),
    ).withColumn("dealt", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32))
    # Written once: the text is read and digested one time, and both uses below read narrow rows.
    rows = common.written(rows.withColumn("dealt", F.floor("dealt")), "shard-rows")
    before = common.running_totals(rows.groupBy("source", "dealt").agg(F.count(F.lit(1)).alias("here")), "dealt", "here", "source").select(
        F.col("source").alias("of_source"), F.col("dealt").alias("of_dealt"), "ahead", F.col("of_all").alias("in_source")
    )
    ranked = (
        rows.withColumn("rank", F.row_number().over(W.partitionBy("source", "dealt").orderBy("digest", "doc_id", "text_crc32")))
        .join(before, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("dealt") == F.col("of_dealt")))
        .withColumn("share", (2 * (F.col("ahead") + F.col("rank")) - 1).cast("double") / (2 * F.col("in_source")).cast("double"))
        .withColumn("place", F.floor(F.col("share") * F.lit(buckets)).cast("long"))
    )
    starts = common.running_totals(ranked.groupBy("place").agg(F.count(F.lit(1)).alias("here")), "place", "here").select(F.col("place").alias("of_place"), F.col("ahead").alias("first"))
    in_place = W.partitionBy("place").orderBy("share", "digest", "doc_id", "text_crc32")
    position = F.col("first") + F.col("row") - 1
    shard = F.floor(position * F.lit(shards) / F.lit(max(1, total))).cast("int")
    return (
        ranked.withColumn("row", F.row_number().over(in_place))
        .join(starts, F.col("place") == F.col("of_place"))
        .withColumn("shard", shard)
        .withColumn("slot", (position - F.ceil(F.col("shard") * F.lit(total) / F.lit(shards))).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


ORACLE_SQL = f"""
WITH crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), base AS (
    SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), crc AS (
    SELECT b.*, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
    FROM base b, crc_table
), ranked AS (
    SELECT doc_id, source, text_crc32, octet_length(encode(text)) + 8 AS size,
           md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(text)) AS digest,
           row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(text)), doc_id) AS r,
           count(*) OVER (PARTITION BY source) AS n
    FROM crc
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, digest, doc_id) - 1 AS p, count(*) OVER () AS total
    FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (p * {SHARDS} // total)::INTEGER AS shard,
       (p - ((p * {SHARDS} // total) * total + {SHARDS} - 1) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM placed
"""
