"""Token ids in binary shards, with a minimal perfect hash index for keyed access.

A shard is two files.  `<name>.ids` is the raw payload: the ids of its documents
end to end, unsigned little-endian 16-bit where the vocabulary allows it, else
32-bit, nothing else.  `<name>.index` is a JSON header line and arrays: the
levels of a minimal perfect hash over the shard's distinct keys, and by hash
slot a stored 32-bit fingerprint, the first record and the number of records of
the key; then the offsets of all records in the payload.  Records without a key
come first; the header counts them.  A lookup computes the slot with a few
probes, compares the fingerprint, and reads one slice, whatever the size of the
shard.

The hash: at each level the keys left over are thrown into a bit array of GAMMA
bits a key; keys alone in their bit settle there, the others go to the next
level.  A key's slot is the number of set bits before its own: a count kept for
each word of 64 bits, and the bits of the word.  Keys outside the index are
refused by the fingerprint, but for one in 2^32.

Rows are dealt by ranges of the key and sorted in each range, so shards in
order hold the keys in order.  There is a shard for each SHARD_ROWS rows, or for
each shuffle partition if that gives more, so neither a shard nor what its
writer holds of it (a key and a size a record) grows with the table.  The rows of
one key, or those without a key, may be a third of all: ranges also part them by
the beginning of their text and then by their place in the input, and a lookup
asks every shard whose range holds the key.  Each task streams its payload to a file whose
name carries the attempt; only files that a successful task reported are in the
manifest, so a lost executor or a second attempt cannot mix files.

Defined cases: a null text is empty and has the end id only; null keys come
first in the order and are kept apart from all 64-bit keys; rows that repeat a
key are kept, in the order of the first PART_CHARS code points of their text (in
a shard, of the whole text); a very long text is one record, encoded as a whole;
an empty table has no shards; extra columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm import textbatch as tb
from spanforge.llm.pretoken import library_vocabulary

GAMMA = 2.0
END_ID = 2
SHARD_ROWS = 200_000
PART_CHARS = 64
#: first_key and last_key are null in a shard that holds records without a key only.
MANIFEST = "shard int, name string, n_docs long, n_nulls long, n_ids long, first_key long, last_key long, bytes_per_id int"


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys; see the module's text."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bit arrays as bytes, little bit order, whole words of 64 bits
        self._words = [x.view("<u8") for x in levels]
        ends = [np.cumsum(np.bitwise_count(w), dtype=np.int64) for w in self._words]
        self._before = [np.concatenate([[0], e[:-1]]) for e in ends]  # set bits before each word
        self._first = tb.bounds_of([e[-1] for e in ends])

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return tb.mixed(keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)

    @classmethod
    def built(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = -(-int(GAMMA * len(left) + 1) // 64) * 64
            at = cls._places(left, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that surely are not in it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, words in enumerate(self._words):
            at = self._places(keys[left], level, 64 * len(words))
            word, place = words[(at >> np.uint64(6)).astype(np.int64)], at & np.uint64(63)
            hit = (word >> place) & np.uint64(1) == 1
            lower = np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            out[left[hit]] = self._first[level] + self._before[level][(at[hit] >> np.uint64(6)).astype(np.int64)] + lower[hit]
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (tb.mixed(keys.astype(np.uint64) ^ np.uint64(0xA5A5A5A5DEADBEEF)) >> np.uint64(32)).astype(np.uint32)


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _index_bytes(keys: np.ndarray, offsets: np.ndarray, nulls: int) -> bytes:
    """keys: of the records in order, equal ones adjacent, after the records without a key."""
    distinct, first, counts = np.unique(keys, return_index=True, return_counts=True)
    mph = PerfectHash.built(distinct)
    slots = mph.slots(distinct)
    prints, record, number = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u8"), np.zeros(len(distinct), "<u4")
    prints[slots], record[slots], number[slots] = fingerprints(distinct), first + nulls, counts
    arrays = [*mph.levels, prints, record, number, offsets.astype("<u8")]
    header = {"levels": len(mph.levels), "nulls": nulls, "arrays": [[a.dtype.str, len(a)] for a in arrays]}
    return json.dumps(header).encode() + b"\n" + b"".join(a.tobytes() for a in arrays)


class Shard:
    """Keyed access to one written shard."""

    def __init__(self, folder: str, name: str, bytes_per_id: int):
        self._fs, base = _filesystem(folder)
        with self._fs.open_input_file(f"{base}/{name}.index") as file:
            raw = file.read()
        head, _, body = raw.partition(b"\n")
        header, arrays, at = json.loads(head), [], 0
        for kind, size in header["arrays"]:
            arrays.append(np.frombuffer(body, kind, size, at))
            at += arrays[-1].nbytes
        self.nulls = header["nulls"]
        self.hash = PerfectHash(arrays[: header["levels"]])
        self.prints, self.record, self.number, self.offsets = arrays[header["levels"] :]
        self.path, self.type = f"{base}/{name}.ids", np.dtype(f"<u{bytes_per_id}")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first record, number of records) of each key; -1 and 0 where it has none."""
        slots = self.hash.slots(keys)
        good = slots >= 0
        good[good] = self.prints[slots[good]] == fingerprints(keys[good])
        first, number = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        first[good], number[good] = self.record[slots[good]], self.number[slots[good]]
        return first, number

    def read(self, records: np.ndarray, most: int = 1 << 22) -> Iterator[np.ndarray]:
        """The ids of ascending records; neighbours are fetched together, about most ids at a time."""
        with self._fs.open_input_file(self.path) as file:
            i, wide = 0, self.type.itemsize
            while i < len(records):
                j = i + 1
                start = int(self.offsets[records[i]])
                while j < len(records) and records[j] == records[j - 1] + 1 and int(self.offsets[records[j] + 1]) - start <= most:
                    j += 1
                stop = int(self.offsets[records[j - 1] + 1])
                file.seek(start * wide)
                ids = np.frombuffer(file.read((stop - start) * wide), self.type)
                for r in records[i:j].tolist():
                    yield ids[int(self.offsets[r]) - start : int(self.offsets[r + 1]) - start]
                i = j


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID, shards: int | None = None) -> DataFrame:
    """Write the shards of docs (doc_id, text) to folder, one for each range of keys; the manifest, written beside them, is returned.

    One shuffle of the texts, by ranges of the key.
    """
    spark = docs.sparkSession
    shards = shards or max(common.shuffle_partitions(spark), -(-docs.count() // SHARD_ROWS))

    common.bounded_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = library_vocabulary(tokenizer)
        wide = 2 if max([*vocabulary.special.values(), end_id or 0, 1 << 15]) < 1 << 16 else 4
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex[:12]}"
        target, base = _filesystem(folder)
        keys, sizes, nulls, out = [], [], 0, None
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            nulls += batch.column(0).null_count  # they come first
            keys.append(batch.column(0).drop_null().to_numpy())
            for b, e in common.slices(texts, 1 << 19):
                flat, bounds = vocabulary(texts[b:e])
                if end_id is not None:
                    flat, bounds = np.insert(flat, bounds[1:], end_id), bounds + np.arange(len(bounds))
                if len(flat) and int(flat.max()) >> (8 * wide):
                    raise ValueError("an id does not fit the payload's type")
                out = out or target.open_output_stream(f"{base}/{name}.ids")
                out.write(flat.astype(f"<u{wide}").tobytes())
                sizes.append(np.diff(bounds))
        if out is None:
            return
        out.close()
        keys, offsets = np.concatenate(keys), tb.bounds_of(np.concatenate(sizes))
        with target.open_output_stream(f"{base}/{name}.index") as index:
            index.write(_index_bytes(keys, offsets, nulls))
        ends = [int(keys[0]), int(keys[-1])] if len(keys) else [None, None]
        row = [task.partitionId(), name, len(offsets) - 1, nulls, int(offsets[-1]), *ends, wide]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["shard", "name", "n_docs", "n_nulls", "n_ids", "first_key", "last_key", "bytes_per_id"])

    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(hadoop)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(shards, "doc_id", F.substring("text", 1, PART_CHARS), "row").sortWithinPartitions("doc_id", "text").drop("row")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def lookup(keys: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the records of keys (doc_id), found through the index and read from the files.

    One shuffle of the keys alone, to the shards whose ranges hold them.  What the
    tasks are handed of the manifest is a row for each shard.
    """
    rows = sorted(tuple(r) for r in manifest.select("shard", "name", "bytes_per_id", "n_ids", "n_nulls", "first_key", "last_key").collect())
    before = tb.bounds_of([r[3] for r in rows])
    with_nulls = np.array([at for at, r in enumerate(rows) if r[4]], np.int64)
    keyed = np.array([at for at, r in enumerate(rows) if r[5] is not None], np.int64)
    firsts, lasts = (np.array([rows[at][c] for at in keyed], np.int64) for c in (5, 6))
    name = keys.columns[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).drop_null().to_numpy()
            low = np.searchsorted(lasts, key, "left")
            number = np.maximum(0, np.searchsorted(firsts, key, "right") - low)
            place, key = keyed[tb.gathered(np.arange(len(keyed)), low, number)], np.repeat(key, number)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(key)], names=["place", "key"])
            if batch.column(0).null_count:
                yield pa.RecordBatch.from_arrays([pa.array(with_nulls.astype(np.int32)), pa.nulls(len(with_nulls), pa.int64())], names=["place", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, shard = -1, None
        for batch in batches:
            places, keys_ = batch.column(0).to_numpy(), batch.column(1)
            for at in np.unique(places).tolist():
                asked = keys_.filter(pa.array(places == at))
                nulls, asked = asked.null_count, np.unique(asked.drop_null().to_numpy())
                if at != opened:
                    opened, shard = at, Shard(folder, rows[at][1], rows[at][2])
                first, number = shard.find(asked)
                records = tb.gathered(np.arange(len(shard.offsets)), np.maximum(first, 0), number)
                found = pa.array(np.repeat(asked, number))
                if nulls:
                    records = np.concatenate([np.arange(shard.nulls), records])
                    found = pa.concat_arrays([pa.nulls(shard.nulls, pa.int64()), found])
                crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in shard.read(records)]
                begin, end = shard.offsets[records].astype(np.int64), shard.offsets[records + 1].astype(np.int64)
                yield pa.RecordBatch.from_arrays([found, pa.array(begin + before[at]), pa.array(end - begin), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = keys.select(F.col(name).cast("long")).distinct().mapInArrow(deal, "place int, key long")
    return dealt.repartition(common.shuffle_partitions(keys.sparkSession), "place").sortWithinPartitions("place", "key").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    folder = common.fresh_path(spark, "token-ids")
    manifest = write_shards(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return lookup(docs.select("doc_id"), manifest, folder)
