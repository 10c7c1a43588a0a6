"""Byte-level BPE encoding and decoding.

Encoding is the backtracking method.  One Aho-Corasick pass over a pre-token
gives, for each position, the longest token that begins there.  Tokens are then
laid from the left: a token may follow another only if the two are compatible,
that is, if the merges of their joined bytes end in just these two.  A sequence
of pairwise compatible tokens is the one that the merge rules give, so where the
longest token does not fit, its next shorter prefix is tried, and where none
fits, the last token is taken back and its end position is never tried again.
Each position is given up at most once, so the work is linear in the length.

Compatibility of a pair follows from the split table (the two halves each token
was merged from): undo the merges on both sides of the joint from the latest to
the earliest, and see whether a merge across the joint had come first.  Answers
are kept in a table.

Decoding lays the bytes of all tokens end to end once; a text is a gather of
runs by an offset table, without a loop over tokens.

Defined cases: a null text is encoded as an empty one, with no ids; null ids
decode to an empty text; special tokens that stand in a text become their id,
as in the tokenizers library; bytes that are no UTF-8 decode to U+FFFD; a null
key is kept; repeated rows are encoded alike, row by row; a very long text is
handled whole in one task; of tokens that fit at a place the longest is tried
first, and the result is that of the merge rules, so there are no ties; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm import textbatch as tb
from spanforge.llm.pretoken import Vocabulary, byte_chars


class Encoder:
    """Merges of a byte-level vocabulary file, by rank: single bytes first, then merged tokens in the order of their merges."""

    def __init__(self, path: str, most_pairs: int = 1_000_000):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = [a + b for a, b in merges]
        singles = [t for t in model["vocab"] if len(t) == 1]
        self.tokens = singles + made
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        if len(self.rank) != len(self.tokens):
            raise ValueError("two merges give the same token")
        self.ids = [model["vocab"][t] for t in self.tokens]
        self.left = [*range(len(singles)), *(self.rank[a] for a, _ in merges)]
        self.right = [*range(len(singles)), *(self.rank[b] for _, b in merges)]
        self.merge_of = {(self.rank[a], self.rank[b]): self.rank[a + b] for a, b in merges}
        self.size = [len(t) for t in self.tokens]
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.most_pairs = most_pairs
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.chars = byte_chars()

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            known = self.pairs[a, b] = self._derive(a, b)
        return known

    def _derive(self, a: int, b: int) -> bool:
        """Undo the later of the two merges next to the joint, again and again.

        A merge across the joint counts if its rank is under latest: it came
        before the merge undone last (of equal ranks, the one on the left).
        """
        latest = len(self.tokens)
        while True:
            across = self.merge_of.get((a, b))
            if across is not None and across < latest:
                return False
            inner, outer = self.right[a], self.left[b]  # a single byte is its own half
            if inner == a and outer == b:
                return True
            if inner != a and (a > b or outer == b):
                latest, a = a, inner
            else:
                latest, b = b + 1, outer

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of token; -1 for none."""
        found = self.shorter.get(token)
        if found is None:
            text = self.tokens[token]
            found = next((self.rank[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.rank), -1)
            self.shorter[token] = found
        return found

    def encode(self, piece: str) -> list[int]:
        chars = self.chars
        text = "".join([chars[b] for b in piece.encode()])
        whole = self.rank.get(text)
        if whole is not None and self.size[whole] < 2:
            return [self.ids[whole]]
        n, size = len(text), self.size
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - size[token]] = token  # a later end is a longer token
        open_end = bytearray(b"\1") * (n + 1)
        laid: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0 and not (open_end[at + size[token]] and (not laid or self.compatible(laid[-1], token))):
                token = self._next_shorter(token)
            if token >= 0:
                laid.append(token)
                at += size[token]
                token = longest[at]
            else:
                if not laid:
                    raise ValueError("a byte is not in the vocabulary")
                open_end[at] = 0
                token = laid.pop()
                at -= size[token]
        return [self.ids[t] for t in laid]


class Decoder:
    """Bytes of all tokens end to end, by id, with their offsets."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        tokens |= {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        runs = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.bytes = np.frombuffer(b"".join(runs), np.uint8)
        self.offsets = tb.bounds_of([len(r) for r in runs])

    def __call__(self, flat: np.ndarray, bounds: np.ndarray) -> list[str]:
        begin = self.offsets[flat]
        size = self.offsets[flat + 1] - begin
        raw, cuts = tb.gathered(self.bytes, begin, size).tobytes(), tb.bounds_of(size)[bounds].tolist()
        return [raw[b:e].decode("utf-8", "replace") for b, e in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    encoder = Encoder(path)
    return Vocabulary(path, lambda pieces: [encoder.encode(p) for p in pieces])


@lru_cache(2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and ids (array of int) of each row's whole text; no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = vocabulary(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for b, e in common.slices(texts):
                flat, bounds = ids_of(texts[b:e])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b, e - b), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """encoded with its text as the column decoded; no shuffle."""
    kind = encoded.schema[key].dataType.simpleString()

    common.bounded_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = decoder(tokenizer)
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            bounds = tb.bounds_of(sizes)
            begin = 0
            while begin < len(sizes):
                end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + (1 << 19), "right")) - 1)
                texts = text_of(flat[bounds[begin] : bounds[end]].astype(np.int64), bounds[begin : end + 1] - bounds[begin])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), column.slice(begin, end - begin), pa.array(texts, pa.string())], names=[key, "ids", "decoded"])
                begin = end

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    both = decode(encode(common.table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
