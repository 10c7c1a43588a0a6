from __future__ import annotations

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from spanforge.llm import vector_packing as vp  # noqa: E402
from tests.llm.data import awkward, empty, prose, table  # noqa: E402
from tests.oracle import FOLDER  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def checked(tokens, loss, limits):
    """Rows of place(), after all that must hold of them."""
    rows = vp.place(np.array(tokens, np.int64), np.array(loss, np.int64), limits).tolist()
    covered, filled = defaultdict(list), defaultdict(list)
    for item, start, length, bears, sequence, offset in rows:
        assert length > 0 and bears == max(0, start + length - max(start, tokens[item] - loss[item]))
        covered[item].append((start, length))
        filled[sequence].append((offset, length, bears))
    for item, n in enumerate(tokens):
        at = 0
        for start, length in sorted(covered[item]):
            assert start == at
            at += length
        assert at == n
    for parts in filled.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits.tokens and (at == limits.tokens or at & (at - 1) == 0)
        assert len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
    return rows, len(filled)


@pytest.mark.parametrize("mix", ["answers", "instructions", "mixed", "tiny", "long", "one"])
@pytest.mark.parametrize("limits", [vp.Limits(), vp.Limits(256, 4, 100), vp.Limits(64, 1, 64), vp.Limits(128, 8, 7)])
def test_limits_hold_and_every_token_is_placed(mix, limits):
    rng = random.Random(11)
    draw = {
        "answers": lambda: (n := rng.randint(1, 900), n),
        "instructions": lambda: (rng.randint(1, 900), 1),
        "mixed": lambda: (n := int(rng.paretovariate(0.7) * 30) % 5000 + 1, rng.randint(1, n)),
        "tiny": lambda: (rng.randint(1, 3), 1),
        "long": lambda: (n := rng.randint(5000, 20000), rng.choice([1, n, n // 2])),
        "one": lambda: (1, 1),
    }[mix]
    pairs = [draw() for _ in range(60 if mix == "long" else 700)]
    rows, sequences = checked([a for a, _ in pairs], [b for _, b in pairs], limits)
    least = max(sum(a for a, _ in pairs) / limits.tokens, sum(b for _, b in pairs) / limits.loss, len(pairs) / limits.segments if limits.segments > 1 else 0)
    if limits == vp.Limits():
        assert sequences <= 1.3 * least + 12  # none has padding; some are shorter


def test_limits_are_met_by_mixing():
    """Answers alone fill only half of a sequence; with instructions beside them all are full."""
    rows, sequences = checked([512] * 100 + [512] * 100, [512] * 100 + [1] * 100, vp.Limits(1024, 32, 520))
    assert sequences <= 103
    by = defaultdict(int)
    for _, _, length, bears, sequence, _ in rows:
        by[sequence] += bears
    assert sum(x > 400 for x in by.values()) > 90


def test_nothing_to_place():
    assert vp.place(np.zeros(0, np.int64), np.zeros(0, np.int64), vp.Limits()).shape == (0, 6)


def test_instruction_ends_where_a_pretoken_does():
    rng = random.Random(2)
    library = Tokenizer.from_file(BYTE)
    texts = ["", "one line", "a\nb", "a\n\nb\n", "\n\nx", "a \x1c\n b", "it's\r\n're", "x<|endoftext|>\ny", "A!\x1c\n\x85z\n", *("".join(rng.choice("ab's!  \n\n\x1c\x85é1") for _ in range(rng.randint(0, 30))) for _ in range(800))]
    for text in texts:
        cut = vp.instruction(text)
        ids = [library.encode(t, add_special_tokens=False).ids for t in (text, text[:cut], text[cut:])]
        assert ids[0] == ids[1] + ids[2], text
    assert vp.instruction("do this\nand that\nan answer\n \n") == len("do this\nand that")


def exact(docs, rows, limits=vp.Limits()):
    library = Tokenizer.from_file(BYTE)
    want, got, filled = Counter(), Counter(), defaultdict(list)
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, vp.END_ID])
        want[doc_id] += len(texts[doc_id][-1])
    for r in rows:
        assert r.doc_tokens in map(len, texts[r.doc_id])
        assert any(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in texts[r.doc_id] if len(ids) == r.doc_tokens)
        got[r.doc_id] += r.length
        filled[r.sequence_id].append(r)
    assert got == want
    for parts in filled.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and at & (at - 1) == 0 and len(parts) <= limits.segments and sum(r.loss_tokens for r in parts) <= limits.loss


def test_packed_documents(spark):
    given = [(r[0], r[1]) for r in awkward()]
    exact(given, vp.packed_documents(table(spark), BYTE).collect())
    exact(given, vp.packed_documents(table(spark), BYTE, part_tokens=300).collect())
    assert vp.packed_documents(empty(spark), BYTE).count() == 0
    long = prose(random.Random(3), 30_000)
    exact([(1, long), (2, None)], vp.packed_documents(spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string"), BYTE).collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    exact(docs, vp.query(spark, FOLDER).collect())
