"""Packing of instruction data under several limits at once, by the dot-product heuristic.

A sequence has limits on its tokens, its segments and its loss-bearing tokens.
A document is an instruction and its answer: the answer, its last line with the
end id, bears loss, the lines before do not.  So an example is a vector of
tokens, one segment, and loss-bearing tokens at its end.

A sequence is filled one example at a time.  Of the examples that fit, the one
with the largest dot product with the room that is left is taken, each limit
weighted by how much of it all examples ask for: what is scarce in the sequence
is spared, what is plenty is used.  Examples of like vectors are a class (their
upper bounds stand for them), so a choice looks at some hundred classes, however
many examples there are.

When nothing fits whole, an example is cut and its head fills the sequence.  A
sequence that cannot be filled, since another limit is reached or nothing is
left, is cut back to a power of two, at which it needs no padding; what is cut
off goes back.  So no sequence has padding at all.

Documents are packed where they are encoded: a task holds the ids of a bounded
number of documents, packs them, and gives their pieces with checksums.  Nothing
is shuffled, so no key can be hot, and a lost task is done again alone.  Each
such part ends in at most a few short sequences.

Defined cases: a null text has the end id only; a text without an earlier line
is all answer; a very long text is held and cut as a whole; a null doc_id is an
ordinary document; repeated rows are packed as often as they are there; ties go
to the smaller class; an empty table gives no rows; extra columns of documents
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm.pretoken import WHITE, library_vocabulary

END_ID = 0
#: Ids that a task holds before it packs them.
PART_TOKENS = 4_000_000
_BLANKS = "".join(map(chr, WHITE))

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


@dataclass(frozen=True)
class Limits:
    """Of a sequence: tokens, a power of two; segments; loss-bearing tokens."""

    tokens: int = 1024
    segments: int = 32
    loss: int = 512


class _Pool:
    """Examples that are still to be placed, by class of tokens and of loss-bearing tokens."""

    STEPS = 32

    def __init__(self, limits: Limits, tokens: np.ndarray, loss: np.ndarray):
        self.step_t, self.step_l = -(-limits.tokens // self.STEPS), -(-limits.loss // self.STEPS)
        up_t, up_l = np.divmod(np.arange((self.STEPS + 1) ** 2), self.STEPS + 1)
        self.tokens, self.loss = np.minimum(up_t * self.step_t, limits.tokens), np.minimum(up_l * self.step_l, limits.loss)
        asked = np.array([tokens.sum() / limits.tokens, loss.sum() / limits.loss])
        asked = asked / max(asked.sum(), 1e-9)
        self.by_tokens, self.by_loss = asked[0] * self.tokens / limits.tokens**2, asked[1] * self.loss / limits.loss**2
        self.context = self.tokens - self.loss
        self.members: list[list[tuple[int, int, int, int]]] = [[] for _ in self.tokens]
        self.some = np.zeros(len(self.tokens), bool)
        self.left = 0

    def add(self, example: tuple[int, int, int, int]) -> None:
        """example: item, start, tokens, loss-bearing tokens (its last ones)."""
        at = -(-example[2] // self.step_t) * (self.STEPS + 1) + -(-example[3] // self.step_l)
        self.members[at].append(example)
        self.some[at] = True
        self.left += 1

    def take(self, at: int) -> tuple[int, int, int, int]:
        example = self.members[at].pop()
        self.some[at] = bool(self.members[at])
        self.left -= 1
        return example

    def best(self, room: int, room_loss: int) -> tuple[int, int, int, int] | None:
        """The example of the largest weighted dot product with the room, of those that fit whole."""
        fits = np.flatnonzero(self.some & (self.tokens <= room) & (self.loss <= room_loss))
        if not len(fits):
            return None
        return self.take(int(fits[np.argmax(self.by_tokens[fits] * room + self.by_loss[fits] * room_loss)]))

    def head(self, room: int, room_loss: int) -> tuple[int, int, int, int] | None:
        """The first tokens, as many as room or all, of the example with most before its loss-bearing tokens; what remains goes back."""
        there = np.flatnonzero(self.some)
        if not len(there) or room < 1:
            return None
        item, start, tokens, loss = self.take(int(there[np.argmax(self.context[there])]))
        size = min(tokens, room, tokens - loss + room_loss)
        if size < 1:
            self.add((item, start, tokens, loss))
            return None
        return self.cut((item, start, tokens, loss), size)

    def cut(self, example: tuple[int, int, int, int], size: int) -> tuple[int, int, int, int]:
        item, start, tokens, loss = example
        inside = max(0, size - (tokens - loss))
        if size < tokens:
            self.add((item, start + size, tokens - size, loss - inside))
        return item, start, size, inside


def _whole(item: int, tokens: int, loss: int, limits: Limits) -> Iterator[tuple[int, int, int, int]]:
    """An item as examples within the limits: cut only if it is beyond them, where a full sequence or its share of loss ends."""
    start = 0
    while tokens:
        size = min(tokens, limits.tokens, tokens - loss + limits.loss)
        inside = max(0, size - (tokens - loss))
        yield item, start, size, inside
        start, tokens, loss = start + size, tokens - size, loss - inside


def place(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> np.ndarray:
    """Rows (item, start, length, loss, sequence, offset) of the pieces of items, the last `loss` of whose `tokens` bear loss.

    Every sequence holds as many tokens as its limit, or a power of two.
    """
    pool = _Pool(limits, tokens, loss)
    alone = int(tokens.sum() / limits.tokens - loss.sum() / limits.loss)  # full sequences without loss beyond these are needed beside loss-bearing tokens
    out: list[tuple[int, int, int, int, int, int]] = []
    n = 0
    for i, (t, k) in enumerate(zip(tokens.tolist(), loss.tolist(), strict=True)):
        for example in _whole(i, t, k, limits):
            if example[2] == limits.tokens and n < alone:  # a sequence of its own
                out.append((*example, n, 0))
                n += 1
            else:
                pool.add(example)
    while pool.left:
        inside, room, room_loss = [], limits.tokens, limits.loss
        while room and len(inside) < limits.segments:
            example = pool.best(room, room_loss) or pool.head(room, room_loss)
            if example is None:
                break
            inside.append(example)
            room, room_loss = room - example[2], room_loss - example[3]
        over = (limits.tokens - room) - (1 << ((limits.tokens - room).bit_length() - 1)) if room else 0
        while over:
            last = inside.pop()
            if last[2] <= over:
                pool.add(last)
                over -= last[2]
            else:
                inside.append(pool.cut(last, last[2] - over))
                over = 0
        offset = 0
        for example in inside:
            out.append((*example, n, offset))
            offset += example[2]
        n += 1
    return np.array(out, np.int64).reshape(-1, 6)


def instruction(text: str) -> int:
    """How many code points come before the white space that parts the last line with anything visible from those before; 0 without one.

    Pre-tokens end where white space begins, so both parts have the ids that they have in the whole text.
    """
    return len(text[: max(text.rstrip(_BLANKS).rfind("\n"), 0)].rstrip(_BLANKS))


def packed_documents(docs: DataFrame, tokenizer: str, limits: Limits | None = None, end_id: int = END_ID, part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens of every piece of docs (doc_id, text)."""
    common.bounded_batches(docs.sparkSession)
    limits = limits or Limits()

    def pieces(held: list, first: int) -> tuple[pa.RecordBatch, int]:
        """The pieces of what is held, in sequences from first on; the next number."""
        ids = np.concatenate([x[1] for x in held])
        tokens, loss = (np.concatenate([x[k] for x in held]) for k in (2, 3))
        found = place(tokens, loss, limits)
        item, start, length = found[:, 0], found[:, 1], found[:, 2]
        raw = memoryview(ids.astype("<u4").tobytes())
        begin = ((np.cumsum(tokens) - tokens)[item] + start).tolist()
        crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin, length.tolist(), strict=True)]
        doc_id = pa.concat_arrays([x[0] for x in held]).take(pa.array(item))
        columns = [doc_id, *map(pa.array, (start, length)), pa.array(crc, pa.int64()), *map(pa.array, (tokens[item], found[:, 4] + first, found[:, 5], found[:, 3]))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECES.split(", ")]), first + int(found[:, 4].max(initial=-1)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = library_vocabulary(tokenizer)
        number = TaskContext.get().partitionId() << 33
        held, size = [], 0
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for b, e in common.slices(texts):
                cuts = [instruction(t) for t in texts[b:e]]
                flat, bounds = vocabulary([part for t, c in zip(texts[b:e], cuts, strict=True) for part in (t[:c], t[c:])])
                ends = bounds[2::2]
                ids = np.insert(flat, ends, end_id).astype(np.int32)
                sizes = np.diff(bounds)
                held.append((keys.slice(b, e - b), ids, sizes[0::2] + sizes[1::2] + 1, sizes[1::2] + 1))
                size += len(ids)
                if size >= part_tokens:
                    out, number = pieces(held, number)
                    held, size = [], 0
                    yield out
        if held:
            yield pieces(held, number)[0]

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, at most 32 segments and 512 loss-bearing tokens."""
    import public_tokenizers

    return packed_documents(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
