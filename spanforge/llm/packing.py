"""Packing token sequences by hierarchical best fit.

A document's ids are cut into pieces of at most the sequence length; only longer
documents are cut.  Pieces are packed in three steps:

1. pieces are dealt evenly into groups of a bounded number of rows, and each
   group is packed by best fit in decreasing order (the open bin with the least
   room that still holds the piece; rooms are a bit mask, so a choice costs the
   same however many bins are open);
2. bins that are nearly full are done;
3. the underfull bins of FAN_IN groups meet and are packed as items, again by
   best fit, and so on up a tree until one group is left.

After a group is packed at most one of its bins is half full or less (two such
bins would have been one), and two bins that are more than half full can never
meet.  So of the bins that the FAN_IN groups of a node hand up, at most FAN_IN
are small, and all that packing them can do is to lay each into a bin with room
for it.  It needs no more than the FAN_IN emptiest bins of the node for that,
and uses up at most as many.  A group therefore hands up its small bin and its
emptiest bins: with at least FAN_IN of them for each level of the tree, all that
any node above can use are there, and the others are done.  MOST_UP is far more
(and is raised to that number if it is less), so that best fit can choose among
many; it bounds what a node holds and costs no sequence.  Only rows of numbers
move; ids stay where they are.

Defined cases: a null text has the end id only; a very long text is cut into
pieces and encoded as a whole; a null doc_id is an ordinary document; repeated
rows are packed as often as they are there; pieces of equal length are taken in
the order of the rows; an empty table gives no rows; extra columns of documents
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm.pretoken import library_vocabulary

LENGTH = 4096
END_ID = 1
GROUP_ROWS = 20_000
FAN_IN = 8
MOST_UP = 2_000
#: A bin with less room than this share of a sequence is done.
DONE = 0.005

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(sizes: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin, offset of each item; use of each bin) by best fit in decreasing order of size."""
    place, offset, use = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    rooms, with_room = 0, [[] for _ in range(capacity + 1)]
    for i in np.argsort(-np.asarray(sizes, np.int64), kind="stable").tolist():
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bins = with_room[room]
            at = bins.pop()
            if not bins:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(use)
            use.append(0)
        place[i], offset[i] = at, use[at]
        use[at] += size
        if room > size:
            if not with_room[room - size]:
                rooms |= 1 << (room - size)
            with_room[room - size].append(at)
    return place, offset, use


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int | None = END_ID) -> DataFrame:
    """A row for each piece of each document of docs (doc_id, text); no shuffle."""

    common.bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = library_vocabulary(tokenizer)
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for b, e in common.slices(texts):
                flat, bounds = vocabulary(texts[b:e])
                if end_id is not None:
                    flat, bounds = np.insert(flat, bounds[1:], end_id), bounds + np.arange(len(bounds))
                size = np.diff(bounds)
                number = -(-size // length)
                doc = np.repeat(np.arange(e - b), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * length
                long = np.minimum(length, size[doc] - start)
                raw = flat.astype("<u4").tobytes()
                begin = (bounds[:-1][doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(begin, long.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(uid, uid + len(doc))), ids.slice(b, e - b).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(long), pa.array(crc, pa.int64())],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
                uid += len(doc)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack(items: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN, most_up: int = MOST_UP) -> DataFrame:
    """items (uid, length, ...; a written table) with sequence_id and offset.

    uid tells rows apart and length is at most the sequence length.
    """
    spark = items.sparkSession
    groups = max(1, -(-items.count() // group_rows))
    least_room = max(1, int(length * DONE))
    levels, left = 1, groups
    while left > 1:
        levels, left = levels + 1, -(-left // fan_in)
    most_up = max(most_up, fan_in * levels)

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        place, offset, _ = best_fit(rows["length"].tolist(), length)
        return rows.assign(bin=place + (np.int64(key[0]) << 24), offset=offset)

    def again(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values(["use", "bin"], ignore_index=True)
        place, offset, use = best_fit(bins["use"].tolist(), length)
        lead = np.zeros(len(use), np.int64)
        lead[place[::-1]] = bins["bin"].to_numpy()[::-1]
        return pd.DataFrame({"bin": bins["bin"], "into": lead[place], "at": offset, "use": np.asarray(use, np.int64)[place]})

    group = F.pmod(F.xxhash64("uid"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long")
    local = common.written(items.withColumn("group", group).groupBy("group").applyInPandas(first, items.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", group long, bin long, offset long"), "packed")
    use = local.groupBy("group", "bin").agg(F.sum("length").alias("use"))

    def underfull(bins: DataFrame) -> DataFrame:
        """What each group hands up: its emptiest bins with room left."""
        rank = F.row_number().over(W.partitionBy("group").orderBy("use", "bin"))
        return bins.where(F.col("use") <= length - least_room).withColumn("rank", rank).where(F.col("rank") <= most_up).drop("rank")

    open_bins = common.written(underfull(use), "open")
    moved = open_bins.select(F.col("bin").alias("of"), F.col("bin").alias("into"), F.lit(0).cast("long").alias("at"))
    if groups > 1:  # the tables that it reads are deleted on the way
        moved = common.written(moved, "moved")
    while groups > 1:
        groups = -(-groups // fan_in)
        merged = common.written(
            open_bins.withColumn("group", F.floor(F.col("group") / fan_in)).groupBy("group").applyInPandas(again, "bin long, into long, at long, use long").join(open_bins.select("bin", F.floor(F.col("group") / fan_in).alias("group")), "bin"),
            "merged",
        )
        common.dropped(open_bins)
        step = merged.select(F.col("bin").alias("old"), F.col("into").alias("new"), F.col("at").alias("more"))
        shifted = common.written(
            moved.join(step, F.col("into") == F.col("old"), "left").select("of", F.coalesce("new", "into").alias("into"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")), "moved"
        )
        common.dropped(moved)
        moved = shifted
        handed = common.written(underfull(merged.groupBy("group", F.col("into").alias("bin")).agg(F.max("use").alias("use"))), "open")
        common.dropped(merged)
        open_bins = handed
    return (
        local.join(moved, F.col("bin") == F.col("of"), "left")
        .withColumn("sequence_id", F.coalesce("into", "bin"))
        .withColumn("offset", F.col("offset") + F.coalesce("at", F.lit(0)))
        .drop("group", "bin", "of", "into", "at")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def packed_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int | None = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs."""
    items = common.written(pieces(docs, tokenizer, length, end_id), "pieces")
    out = pack(items, length).drop("uid")
    common.dropped(items)
    return out
