from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from spanforge.llm import bpe, packing, pretoken, token_files  # noqa: E402
from spanforge.llm import textbatch as tb  # noqa: E402
from tests.llm.data import awkward, empty, prose, table  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [r[1] or "" for r in awkward()]
ALPHABET = "ab cd's 'S 're'll''t  \n\t\r 12 ½ é ñ .,!?- 漢字 Σς İ é 👍🏽​ ʼ'd've'm\0\x1c\x85"


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(1)
    drawn = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    return [*TEXTS, *drawn, "<|endoftext|>", " <|startoftext|><|endoftext|>x", "'", "'re", *("ab" * k for k in range(40)), *("=" * k for k in range(80))]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pretokens_give_the_library_ids(path, fuzz):
    library = Tokenizer.from_file(path)
    flat, bounds = pretoken.library_vocabulary(path)(fuzz)
    for i, want in enumerate(library.encode_batch(fuzz, add_special_tokens=False)):
        assert flat[bounds[i] : bounds[i + 1]].tolist() == want.ids, fuzz[i]


def test_backtracking_gives_the_library_ids_and_round_trips(fuzz):
    library = Tokenizer.from_file(BYTE)
    flat, bounds = bpe.vocabulary(BYTE)(fuzz)
    decoded = bpe.decoder(BYTE)(flat, bounds)
    for i, want in enumerate(library.encode_batch(fuzz, add_special_tokens=False)):
        assert flat[bounds[i] : bounds[i + 1]].tolist() == want.ids, fuzz[i]
        assert decoded[i] == library.decode(want.ids, skip_special_tokens=False) == fuzz[i]


def test_table_of_pretokens_is_emptied():
    vocabulary = pretoken.Vocabulary(BYTE, lambda pieces: [[len(p)] for p in pieces], most=3)
    for _ in range(3):
        flat, _ = vocabulary(["aa bbb cccc ddddd eeeeee"])
        assert flat.tolist() == [2, 4, 5, 6, 7]
    assert len(vocabulary.place) <= 5


def test_invalid_bytes_decode_to_replacement():
    broken = bpe.vocabulary(BYTE)(["é"])[0][:1]
    assert isinstance(bpe.decoder(BYTE)(broken, np.array([0, len(broken)]))[0], str)
    assert bpe.decoder(BYTE)(np.array([], np.int64), np.array([0, 0])) == [""]


def test_encode_and_decode_tables(spark):
    rows = bpe.decode(bpe.encode(table(spark), BYTE), BYTE)
    assert Counter(r.decoded for r in rows.collect()) == Counter(TEXTS)
    assert bpe.decode(bpe.encode(empty(spark), BYTE), BYTE).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(nulls, BYTE).first().decoded == ""


def test_perfect_hash_is_minimal_and_refuses_others():
    keys = np.unique(np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 5000))
    slots = token_files.PerfectHash.built(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert token_files.PerfectHash.built(keys[:0]).slots(keys[:2]).tolist() == [-1, -1]


def test_shards_round_trip(spark, tmp_path):
    docs = table(spark)
    folder = f"file://{tmp_path}/shards"
    manifest = token_files.write_shards(docs, folder, BYTE, shards=3)
    got = sorted(map(tuple, token_files.lookup(docs.select("doc_id"), manifest, folder).collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
    library = Tokenizer.from_file(BYTE)
    want, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    row = max(manifest.collect(), key=lambda r: r.n_docs)
    shard = token_files.Shard(folder, row.name, row.bytes_per_id)
    first, number = shard.find(np.array([987654321]))
    assert first.tolist() == [-1] and number.tolist() == [0]
    unknown = spark.createDataFrame([(987654321,)], "doc_id long")
    assert token_files.lookup(unknown, manifest, folder).count() == 0


def test_shards_part_hot_keys_and_keep_null_apart(spark, tmp_path):
    rows = [(-(1 << 63), "the least key", "x")] + [(None, f"no key {i % 7}", "x") for i in range(60)] + [(5, "hot", "x")] * 60 + [(i, f"text {i}", "x") for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    folder = f"file://{tmp_path}/hot"
    manifest = token_files.write_shards(docs, folder, BYTE, shards=6)
    shards = sorted(manifest.collect())
    assert sum(r.n_docs for r in shards) == len(rows) and sum(r.n_nulls for r in shards) == 60
    assert max(r.n_docs for r in shards) < 50 and sum(r.first_key is not None and r.first_key <= 5 <= r.last_key for r in shards) > 1
    got = token_files.lookup(docs.select("doc_id"), manifest, folder).collect()
    library = Tokenizer.from_file(BYTE)
    ids = [(d, [*library.encode(t, add_special_tokens=False).ids, token_files.END_ID]) for d, t, _ in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_shards_of_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    manifest = token_files.write_shards(empty(spark), folder, BYTE)
    assert manifest.count() == 0 and token_files.lookup(empty(spark).select("doc_id"), manifest, folder).count() == 0


def test_best_fit_is_valid_and_close():
    rng = random.Random(3)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    place, offset, use = packing.best_fit(sizes, 100)
    filled = Counter()
    for size, b, o in sorted(zip(sizes, place.tolist(), offset.tolist(), strict=True), key=lambda x: (x[1], x[2])):
        assert o == filled[b]
        filled[b] += size
    assert max(use) <= 100 and len(use) <= 1.02 * sum(sizes) / 100


def packed_ok(rows, length):
    filled = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values(), default=0) <= length
    return len(filled)


def test_packed_documents(spark):
    rows = packing.packed_documents(table(spark), WORD, length=256).collect()
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for r in awkward():
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, packing.END_ID]
        for n, s in enumerate(range(0, len(ids), 256)):
            want[r[0], n, s, len(ids[s : s + 256]), zlib.crc32(np.array(ids[s : s + 256], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packed_ok(rows, 256) <= -(-sum(r.length for r in rows) // 256) + 1
    assert packing.packed_documents(empty(spark), WORD).count() == 0


def test_tree_of_groups(spark):
    from spanforge.llm import common

    rng = random.Random(5)
    items = [(i, rng.choice([rng.randint(1, 200), rng.randint(900, 1000), 1000])) for i in range(4000)]
    table_ = common.written(spark.createDataFrame(items, "uid long, length long"), "items")
    rows = packing.pack(table_, 1000, group_rows=200, fan_in=3).collect()
    assert sorted((r.uid, r.length) for r in rows) == items
    best = len(packing.best_fit([n for _, n in items], 1000)[2])
    assert packed_ok(rows, 1000) <= best * 1.03 + 1


@pytest.mark.parametrize("mix", ["small", "halves", "large and few small", "large", "long tail"])
def test_bins_left_behind_cost_no_sequence(spark, mix):
    from spanforge.llm import common

    rng = random.Random(6)
    draw = {
        "small": lambda: rng.randint(1, 60),
        "halves": lambda: rng.randint(480, 520),
        "large and few small": lambda: rng.randint(501, 990) if rng.random() < 0.98 else rng.randint(1, 400),
        "large": lambda: rng.randint(501, 995),
        "long tail": lambda: min(1000, int(rng.paretovariate(0.6) * 5)),
    }[mix]
    sizes = [(i, draw()) for i in range(3000)]
    items = common.written(spark.createDataFrame(sizes, "uid long, length long"), "items")
    used = {}
    for most_up in (1, 10**9):  # 1: raised to what the tree needs
        rows = packing.pack(items, 1000, group_rows=100, fan_in=3, most_up=most_up).collect()
        assert sorted((r.uid, r.length) for r in rows) == sizes
        used[most_up] = packed_ok(rows, 1000)
    assert used[1] <= used[10**9]


def test_very_long_text_is_cut(spark):
    text = prose(random.Random(4), 30_000)
    rows = packing.packed_documents(spark.createDataFrame([(7, text), (8, "short")], "doc_id long, text string"), WORD).collect()
    ids = [*Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 7) == [
        (n, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for n, s in enumerate(range(0, len(ids), 4096))
    ]
    assert packed_ok(rows, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_gathered():
    assert tb.gathered(np.arange(10), np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]


def test_one_very_long_text():
    text = prose(random.Random(2), 60_000)
    flat, bounds = pretoken.library_vocabulary(BYTE)([text, ""])
    assert bounds.tolist() == [0, len(flat), len(flat)]


def thue_morse(n: int) -> tuple[str, str]:
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_patterned_words_keep_their_own_ids(path, monkeypatch):
    texts = [t for n in (512, 1024, 4096) for t in thue_morse(n)]
    library = Tokenizer.from_file(path)
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    encoders = [pretoken.library_vocabulary(path)] + ([bpe.vocabulary(path)] if path == BYTE else [])
    for ids_of in encoders:
        flat, bounds = ids_of(texts)
        assert [flat[b:e].tolist() for b, e in zip(bounds[:-1], bounds[1:], strict=True)] == want
    monkeypatch.setattr(tb, "span_hashes", lambda codes, begin, end: np.zeros(len(begin), np.uint64))
    for ids_of in encoders:  # even if all hashes are equal
        flat, bounds = ids_of(texts + TEXTS[:9])
        assert [flat[b:e].tolist() for b, e in zip(bounds[:-1], bounds[1:], strict=True)][: len(want)] == want


def test_unlike_spans():
    codes, bounds = tb.pack(["abc", "abd", "abc", "ab"])
    assert tb.unlike(codes, bounds[:-1], bounds[1:], np.zeros(4, np.int64)).tolist() == [False, True, False, True]
