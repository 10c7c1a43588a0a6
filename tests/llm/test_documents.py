from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from spanforge.llm import common, fingerprints, language_id, license_scan, near_dedup, quality, sharding
from tests.llm.data import awkward, empty, prose, table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- Sharding ----------------------------------------------------------------


def test_shards_follow_the_mixture(spark):
    rng = random.Random(1)
    rows = [(i, f"text {i}", None, "hot" if rng.random() < 0.4 else f"s{i % 5}", None, None, None, None) for i in range(2000)]
    got = sharding.stratified_shards(table(spark, rows), shards=7, bucket_rows=64).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
        hot = sum(r.source == "hot" for r in got if r.shard == s)
        assert abs(hot - sizes[s] * sum(r.source == "hot" for r in got) / 2000) <= 2


def test_shards_awkward(spark):
    got = sharding.stratified_shards(table(spark)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in awkward())
    assert sharding.stratified_shards(empty(spark)).count() == 0


def test_running_totals_in_chunks(spark):
    rng = random.Random(3)
    rows = [(by, i, rng.randint(1, 9)) for by in ("a", None, "b") for i in range(50) if rng.random() < 0.8]
    got = common.running_totals(spark.createDataFrame(rows, "by string, place long, n long"), "place", "n", "by", chunk=7).collect()
    assert len(got) == len(rows)
    for r in got:
        same = [x for x in rows if x[0] == r.by]
        assert (r.ahead, r.of_all) == (sum(n for _, i, n in same if i < r.place), sum(n for _, _, n in same))


def test_shards_spread_equal_texts(spark):
    rows = [(i, "the same" if i % 2 else f"text {i} " * 2000, None, None, None, None, None, None) for i in range(480)]
    got = sharding.stratified_shards(table(spark, rows), bucket_rows=16).collect()
    same = Counter(r.shard for r in got if r["size"] == 16)
    assert sum(same.values()) == 240 and len(same) == sharding.SHARDS
    assert sorted((r.shard, r.slot) for r in got) == [(s, n) for s in range(24) for n in range(20)]


# --- Fingerprints ------------------------------------------------------------


def likeness(a: str, b: str) -> float:
    def bag(t):
        w = [None, None, *WORDS.findall(t)]
        return Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))

    x, y = bag(a), bag(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys) if keys else 1.0


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(2)
    errors = []
    for _ in range(150):
        words = prose(rng, 300).split()
        a = " ".join(words)
        cut = rng.randint(0, 300)
        b = " ".join(words[:cut] * rng.randint(1, 2) + prose(rng, 300 - cut + 3).split())
        s = fingerprints.signatures([a, b])
        errors.append(fingerprints.likeness(s[:1], s[1:])[0] - likeness(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_signatures_do_not_depend_on_the_batch():
    texts = [r[1] or "" for r in awkward()]
    together = fingerprints.signatures(texts)
    alone = np.vstack([fingerprints.signatures([t], block=100) for t in texts])
    assert (together == alone).all()
    assert not together[4].any() and (together[0] == together[1]).all()


def test_fingerprints_awkward(spark):
    rows = [(i, r[1]) for i, r in enumerate(awkward())]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, part boolean")
    got = {r.doc_id: r for r in fingerprints.fingerprinted(docs).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert got[doc_id].n_chars == len(text)
        assert got[doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(got[doc_id].near_edited - likeness(text, changed)) < 0.35
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    one = spark.createDataFrame([(5, "alone in the table")], "doc_id long, text string")
    assert fingerprints.fingerprinted(one).first().near_next == 1.0
    assert fingerprints.fingerprinted(empty(spark)).count() == 0
    assert fingerprints.fingerprinted(table(spark)).count() == len(awkward())


def test_fingerprints_of_one_hot_doc_id(spark):
    rng = random.Random(5)
    texts = [prose(rng, 12) for _ in range(300)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, "after them")], "doc_id long, text string").repartition(4)
    dealt = fingerprints.with_next(docs).withColumn("task", fingerprints.F.spark_partition_id()).where("rank = 0 and doc_id is null").groupBy("task").count().collect()
    assert len(dealt) > 1
    got = fingerprints.fingerprinted(docs).collect()
    assert Counter(r.n_chars for r in got) == Counter([*map(len, texts), 10])
    assert len({r.edited_sha256 for r in got}) == 301


# --- Quality -----------------------------------------------------------------


def brute_counts(text: str) -> tuple:
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), len(lines))


def test_counts_equal_brute_force():
    rng = random.Random(4)
    texts = [r[1] or "" for r in awkward()] + ["".join(rng.choice("ab #|\n\t\x0b é") for _ in range(rng.randint(0, 80))) for _ in range(300)] + ["a b c d e f g h " * 3, "x\n\nx\n"]
    found = quality.counts(texts)
    assert [tuple(int(found[c][i]) for c in quality.COUNTS) for i in range(len(texts))] == [brute_counts(t) for t in texts]


def test_host_verdicts(spark):
    rng = random.Random(6)
    clean, soft = prose(rng, 60), "\n".join(["tiny line here"] * 5 + [prose(rng, 200).replace("\n", " ")])
    rows = [(i, clean if i % 10 else "bad", "en", "good", 0, None, None, None) for i in range(60)]
    rows += [(100 + i, clean if i == 0 else "bad", "en", "spam", 0, None, None, None) for i in range(60)]
    rows += [(200, soft, "en", "good", 0, None, None, None), (201, soft, "en", "spam", 0, None, None, None)]
    got = {r.doc_id: r for r in quality.judged(table(spark, rows)).collect()}
    assert got[200].soft_failed == 1 and not got[200].base_failed
    assert got[1].kept and got[100].kept and not got[0].kept
    assert got[200].kept and not got[201].kept
    assert got[201].host_rate > quality.DOUBT > got[200].host_rate


def test_quality_awkward(spark):
    got = quality.judged(table(spark)).collect()
    assert len(got) == len(awkward()) and not any(r.kept for r in got if r.n_words < quality.MIN_WORDS)
    kept = quality.accepted(table(spark))
    assert kept.schema == table(spark).schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert quality.judged(empty(spark)).count() == 0 and quality.accepted(empty(spark)).count() == 0


def test_very_long_and_repeated_texts_are_counted_whole(spark):
    long = prose(random.Random(22), 40_000)
    rows = [(i, long, "en", "host", None, None, None, None) for i in (1, 1, 2)]
    got = quality.judged(table(spark, rows)).collect()
    assert len(got) == 3 and {(r.n_words, r.word_chars) for r in got} == {brute_counts(long)[:2]} and len({r.kept for r in got}) == 1


def test_many_hosts_are_joined_with_salts(spark, monkeypatch):
    want = sorted(map(repr, quality.judged(table(spark)).collect()))
    monkeypatch.setattr(quality, "BROADCAST_HOSTS", 0)
    assert sorted(map(repr, quality.judged(table(spark)).collect())) == want


# --- Near duplicates ---------------------------------------------------------


def brute_components(rows: list[tuple]) -> dict:
    sets = {}
    for doc_id, text in rows:
        w = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_group(rng: random.Random, base: list[str], n: int, edits: int) -> list[str]:
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("edits", [2, 9])
def test_components_equal_brute_force(spark, edits):
    rng = random.Random(edits)
    texts = near_group(rng, prose(rng, 150).split(), 120, edits) + near_group(rng, prose(rng, 90).split(), 40, 3) + [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    texts += [texts[0]] * 20 + ["", None, "Hi", "hi", "HI there", "É", "é"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.linked(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("step", ["_exhaustive", "_by_prefixes"])
def test_rest_of_hot_buckets_is_compared_exactly(spark, monkeypatch, step):
    rng = random.Random(21)
    base = prose(rng, 120).split()
    texts = near_group(rng, base, 150, 8) + near_group(rng, base[:100] + prose(rng, 12).split(), 60, 5) + near_group(rng, base[15:] + prose(rng, 9).split(), 40, 6) + [" ".join(base)] * 30
    rows = list(enumerate(texts))
    reached = []
    compared = getattr(near_dedup, step)

    def watched(contested, docs, shingle):
        parts = contested.select("part").distinct().count()
        out = compared(contested, docs, shingle)
        reached.append((parts, out.count()))
        return out

    monkeypatch.setattr(near_dedup, step, watched)
    if step == "_by_prefixes":
        monkeypatch.setattr(near_dedup, "DIRECT", 1)
    for rounds in (0, 2):
        monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == brute_components(rows)
    parts, links = reached[0]
    assert parts > 2 and links > 0


def test_linked_sets_share_a_rare_shingle(spark):
    rng = random.Random(22)
    sets = {}
    for i in range(60):
        base = [rng.randint(-(2**63), 2**63 - 1) for _ in range(rng.randint(1, 60))]
        sets[2 * i], sets[2 * i + 1] = set(base), {rng.randint(0, 2**40) if rng.random() < 0.08 else x for x in base}
    rows = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "doc_id long, shingles array<long>")
    first = {}
    for r in near_dedup._rare_prefixes(rows).collect():
        assert r.n == len(sets[r.doc_id])
        first.setdefault(r.doc_id, {})[r.token] = r.n - r.place
    for a, x in sets.items():
        assert set(first[a]) <= x and sorted(first[a].values(), reverse=True) == [len(x) - i for i in range(len(x) - -(-85 * len(x) // 100) + 1)]
        for b, y in sets.items():
            if len(x) <= len(y) and 100 * len(x & y) >= 85 * len(x | y):
                assert any(185 * first[a][s] >= 170 * len(x) and 185 * min(first[a][s], first[b][s]) >= 85 * (len(x) + len(y)) for s in first[a].keys() & first[b].keys())


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (103, 103)], "a long, b long")
    got = {r.id: r.component for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}


def test_estimate_corrects_collisions():
    rng = random.Random(8)
    words = prose(rng, 400).split()
    a, b = " ".join(words), " ".join(words[:320] + prose(rng, 80).split())
    hashes, bounds = near_dedup.sets([a, b])
    least = near_dedup.minima(hashes, bounds)
    low = near_dedup.tb.mixed(least) & np.uint64(3)
    x, y = set(hashes[: bounds[1]].tolist()), set(hashes[bounds[1] :].tolist())
    assert abs(((low[0] == low[1]).mean() - 0.25) / 0.75 - len(x & y) / len(x | y)) < 0.2


def test_dedup_awkward(spark):
    got = near_dedup.linked(table(spark)).collect()
    assert len(got) == len(awkward())
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == 0 and by[2].component_id == 0 and by[3].kept and by[None].kept and by[None].component_id is None
    kept = near_dedup.deduplicated(table(spark))
    assert kept.schema == table(spark).schema
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 3, 4, 5, None} <= set(ids) and not {1, 2, 13} & set(ids)
    assert near_dedup.linked(empty(spark)).count() == 0 and near_dedup.deduplicated(empty(spark)).count() == 0


def test_columns_of_any_name_and_type_are_carried(spark):
    schema = "doc_id long, text string, _p int, _flag boolean, _gone long, _byte int, _again long, `__odd.name` string, m map<string, int>, _bitmap binary"
    rows = [(i, prose(random.Random(i % 3), 60), 1, True, 5, 2, i, "x", {"a": i}, b"z") for i in range(6)]
    rows += [(4, "twice the id", 1, None, 5, 2, 4, "y", {"b": 1}, b"z"), rows[5], (None, "no id", 1, False, None, 0, 0, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    kept = near_dedup.deduplicated(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id is None, r.doc_id or 0, r["__odd.name"]) for r in kept.collect()) == [(False, 0, "x"), (False, 1, "x"), (False, 2, "x"), (True, 0, None)]


def test_flags_lose_no_id(spark):
    rows = spark.range(3000).withColumnRenamed("id", "doc_id")
    ids = spark.range(0, 3000, 17)
    got = near_dedup.flagged(rows, ids, "asked").where("asked").select("doc_id").collect()
    assert {r.doc_id for r in got} >= set(range(0, 3000, 17)) and len(got) < 600


# --- Language ----------------------------------------------------------------

TONGUES = {"aa": "lorem ipsum dolor sit amet consectetur", "bb": "wyz kxq zwyk qxz wykz xqk", "cc": "être élève forêt très août naïf"}


def speech(rng, lang, n):
    return " ".join(rng.choice(TONGUES[lang].split()) for _ in range(n))


def labelled(n=240):
    rng = random.Random(9)
    return [(i, speech(rng, lang, rng.randint(10, 60)), lang, "s", 0, None, None, None) for i in range(n) for lang in [list(TONGUES)[i % 3]]]


def test_network_learns_and_holds_out(spark):
    docs = table(spark, labelled())
    model = language_id.fitted(docs)
    rows = language_id.identified(docs, model).join(docs.select("doc_id", "lang", language_id.held_out().alias("held")), "doc_id").collect()
    held = [r for r in rows if r.held]
    assert {r.doc_id for r in held} == {i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and 0 <= r.position_share <= 1 for r in rows)


def test_gradients_equal_differences():
    model = language_id.trained([("abc", "x"), ("dée", "y")], epochs=1, hidden=3)
    windows, labels = np.random.default_rng(0).integers(97, 101, (5, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    inside = np.ones((5, 4), bool)

    def loss():
        p = language_id.probabilities(model, windows)
        return -np.log(p[:, labels, np.arange(4)]).mean()

    for w, g in zip(language_id._weights(model), language_id._gradients(model, windows, labels, inside), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = w[at], 1e-2
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3


def test_language_awkward(spark):
    model = language_id.trained([("some words", "aa"), ("wyz kxq", "bb")], epochs=2)
    got = {r.doc_id: r for r in language_id.identified(table(spark), model).collect()}
    for i in (3, 4, 5, 11):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[0].lang_pred in ("aa", "bb") and got[0].score == got[1].score
    assert language_id.identified(empty(spark), language_id.fitted(empty(spark))).count() == 0
    nothing = language_id.identified(table(spark), language_id.trained([])).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    kept = language_id.accepted(table(spark), model)
    assert kept.schema == table(spark).schema and {3, 4, 5, 11}.isdisjoint({r.doc_id for r in kept.collect()})
    untold = language_id.accepted(table(spark), language_id.trained([]))
    assert sorted(str(r.doc_id) for r in untold.collect()) == sorted(str(r[0]) for r in awkward() if r[1] and re.search(r"[^\W\d_]", r[1]))


def brute_pooled(model, text: str) -> dict:
    """Probabilities of a whole text, byte by byte, from the network's equations."""

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    raw, pooled = text.encode(), np.zeros(len(model.labels))
    for low in range(0, len(raw), language_id.WINDOW):
        window = list(raw[low : low + language_id.WINDOW])
        filled = window + [0] * (language_id.WINDOW - len(window))
        logits = [model.bias.astype(float).copy() for _ in filled]
        for layer, out, order in zip(model.layers, model.out, (range(len(filled)), reversed(range(len(filled)))), strict=True):
            size = out.shape[0]
            h = np.zeros(size)
            for t in order:
                gates = sigmoid(layer.gates_in[filled[t]] + h @ layer.gates)
                new = np.tanh(layer.cand_in[filled[t]] + gates[size:] * (h @ layer.cand))
                h = gates[:size] * h + (1 - gates[:size]) * new
                logits[t] = logits[t] + h @ out
        for x in logits[: len(window)]:
            pooled += np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    return dict(zip(model.labels, pooled / len(raw), strict=True))


def test_pooled_predictions_equal_brute_force(spark):
    model = language_id.fitted(table(spark, labelled(90)))
    rng = random.Random(16)
    texts = [speech(rng, lang, n) for lang in TONGUES for n in (1, 9, 200)] + ["é", "a" * 64, "x" * 65, prose(rng, 3000)]
    best, score, _ = language_id.predicted(model, texts)
    for text, lang, got in zip(texts, best, score, strict=True):
        want = brute_pooled(model, text)
        assert abs(got - max(want.values())) < 1e-4 and want[lang] > max(want.values()) - 1e-4


def test_every_label_is_learned_within_the_sample(spark):
    rng = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join(rng.choice(letters[k % 26] + letters[(k // 26) * 7 % 26]) * 3 for _ in range(30)), f"l{k:03d}", "s", 0, None, None, None) for i, k in enumerate(list(range(100)) * 8)]
    model = language_id.fitted(table(spark, rows), sample=200, windows=1)
    assert model.labels == [f"l{k:03d}" for k in range(100)]
    same = [(6, speech(rng, "aa", 30), "aa", "s", 0, None, None, None)] * 500 + [(8, speech(rng, "bb", 30), "bb", "s", 0, None, None, None)]
    assert language_id.fitted(table(spark, same)).labels == ["aa", "bb"]


def test_filter_rejects_unexpected_languages_and_low_scores(spark):
    docs = table(spark, labelled())
    model = language_id.fitted(docs)
    assert 1 / 3 < model.floor <= 1 / 3 + language_id.LIFT
    assert language_id.accepted(docs, model).count() == 240
    kept = language_id.accepted(docs, model, ["aa", "cc", "zz"]).collect()
    assert {r.lang for r in kept} == {"aa", "cc"} and len(kept) == 160
    model.floor = 1.1
    assert language_id.accepted(docs, model).count() == 0


def test_language_of_the_documents_table(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    rows = language_id.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").where("lang is not null").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) >= 0.97


# --- Licenses ----------------------------------------------------------------


def test_scan_finds_exact_and_changed_wordings(spark):
    rng = random.Random(10)
    mit = license_scan.TEMPLATES["MIT"][1]
    texts = [
        prose(rng, 50) + "\nReleased under the MIT License.\n" + prose(rng, 50),
        prose(rng, 30) + " " + mit.replace("any person", "every person") + " " + prose(rng, 30),
        "The licensed taxi drove on. " + prose(rng, 40),
        "All rights reserved. " + prose(rng, 400) + " Licensed under the Apache License, Version 2.0.",
        None,
        "",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = sorted((r.doc_id, r.license, r.n_differences, r.exact) for r in license_scan.scan(docs).collect())
    assert got == [(0, "MIT", 0, True), (1, "MIT", 1, False), (3, "Apache-2.0", 0, True), (3, "Proprietary", 0, True)]
    for r in license_scan.scan(docs).collect():
        assert texts[r.doc_id][r.begin : r.end] == r.block
    assert license_scan.scan(empty(spark)).count() == 0
    assert license_scan.scan(table(spark)).count() == 0


def test_scan_finds_every_verbatim_notice_in_prose_and_dense_blocks(spark):
    rng = random.Random(13)
    notices = [(name, t) for name, ts in license_scan.TEMPLATES.items() for t in ts]
    texts, want = [], []
    for name, t in notices:
        for _ in range(8):
            texts.append(prose(rng, 60) + " " + t + " " + prose(rng, 60))
            want.append((len(texts) - 1, name))
    texts.append(" ".join(prose(rng, 20) + " license " + t for _, t in notices * 3))
    want += [(len(texts) - 1, name) for name in license_scan.TEMPLATES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hits = license_scan.scan(docs).collect()
    assert sorted({(r.doc_id, r.license) for r in hits if r.exact}) == sorted(want)
    assert all(r.saved_percent == 100 for r in hits if r.exact and r.doc_id < len(texts) - 1)


def test_scan_finds_wrapped_repunctuated_and_edited_notices(spark):
    rng = random.Random(14)
    mit = license_scan.TEMPLATES["MIT"][1]
    gpl = license_scan.TEMPLATES["GPL-3.0"][1]
    cases = [
        ("All rights\nreserved.", ("Proprietary", 0, True)),
        ("All rights reserved", ("Proprietary", 0, False)),
        ("All rights are reserved.", ("Proprietary", 1, False)),
        ("Released under the MIT License,", ("MIT", 0, False)),
        ("Released under the old MIT License.", ("MIT", 1, False)),
        ("Published under the MIT License.", ("MIT", 1, False)),
        ("Licensed under\n   CC BY 4.0;", ("CC-BY-4.0", 0, False)),
        ("Licensed under CC BY-NC 4.0.", ("CC-BY-NC-4.0", 0, True)),
        (mit.replace("Permission is hereby", "Permission is\nhereby"), ("MIT", 0, True)),
        (mit.replace("Permission is hereby", "Permission is herewith"), ("MIT", 1, False)),
        ("# " + mit.replace(" obtaining", "\n# obtaining"), ("MIT", 0, False)),
        (gpl.replace("redistribute", "share").replace("License as", "Licence as"), ("GPL-3.0", 2, False)),
        (" " * 900 + gpl.replace("redistribute", "share").replace(" ", " " * 30), ("GPL-3.0", 1, False)),
        ("She kept all rights to the film and a reserved seat. Some rights reserved.", None),
    ]
    docs = spark.createDataFrame([(i, f"{prose(rng, 60)} {t} {prose(rng, 60)}") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = sorted((r.doc_id, r.license, r.n_differences, r.exact) for r in license_scan.scan(docs).collect())
    assert got == [(i, *hit) for i, (_, hit) in enumerate(cases) if hit]


def test_scan_misses_no_edit_within_the_limit():
    rng = random.Random(15)
    for name, ts in license_scan.TEMPLATES.items():
        for t in ts:
            words = t.split()
            for _ in range(20):
                some = list(words)
                for _ in range(license_scan.most_differences(len(license_scan.words_of(t)))):
                    at = rng.randrange(1, len(some))
                    if len(words) < license_scan.LEAST_WORDS:
                        some.insert(at, "zzz")
                    else:
                        some[at : at + rng.randint(0, 1)] = rng.choice([["zzz"], []])
                text = f"{prose(rng, 50)} {' '.join(some)} {prose(rng, 50)}"
                assert name in {h[0] for b, e in license_scan.blocks(text) for h in license_scan.scanned(text[b:e])}


def test_word_differences_equal_brute_force():
    def brute(t, b):
        def edit(x, y):
            row = list(range(len(y) + 1))
            for i, a in enumerate(x, 1):
                row = _next(row, i, a, y)
            return row[-1]

        def _next(row, i, a, y):
            out = [i]
            for j, c in enumerate(y, 1):
                out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (a != c)))
            return out

        return min(edit(t, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))

    rng = random.Random(11)
    for _ in range(200):
        t = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        b = [rng.choice("abc") for _ in range(rng.randint(0, 8))]
        assert license_scan.differences(t, b) == brute(t, b)


def test_scan_reports_each_occurrence_with_its_own_range(spark):
    rng = random.Random(18)
    mit, full = "Released under the MIT License.", license_scan.FULL_TEXTS["MIT"]
    changed = full.replace("merge, ", "").replace("FITNESS", "SUITABILITY")
    texts = [
        f"{prose(rng, 30)} {mit} {mit}\n{prose(rng, 300)} {mit} {prose(rng, 9)}",
        f"{prose(rng, 200)}\n{full}\n{prose(rng, 200)}",
        f"{prose(rng, 20)} {changed} All rights reserved. {prose(rng, 20)}",
        " ".join([mit, "All rights reserved."] * 400),
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, texts[0]), (9, texts[0]), (None, mit)], "doc_id long, text string")
    rows = license_scan.scan(docs).collect()
    by = {d: sorted((r.begin, r.end, r.license, r.n_differences, r.exact, r.changes) for r in rows if r.doc_id == d) for d in {r.doc_id for r in rows}}
    at = [m.start() for m in re.finditer(re.escape(mit), texts[0])]
    assert by[0] == [(b, b + len(mit) - 1, "MIT", 0, True, "") for b in at]
    assert by[1] == [(texts[1].index(full), texts[1].index(full) + len(full) - 1, "MIT", 0, True, "")]
    assert [x[2:] for x in by[2]] == [("MIT", 2, False, "-merge -fitness +suitability"), ("Proprietary", 0, True, "")]
    assert Counter(x[2] for x in by[3]) == {"MIT": 400, "Proprietary": 400}
    assert len(by[9]) == 6 and len(by[None]) == 1


def test_scan_recall_on_planted_and_edited_full_texts():
    rng = random.Random(19)
    found = total = 0
    for name, t in license_scan.FULL_TEXTS.items():
        words = t.split()
        for edits in (0, 3, len(words) // 12):
            for _ in range(4):
                some = list(words)
                for _ in range(edits):
                    at = rng.randrange(len(some))
                    some[at : at + rng.randint(0, 1)] = rng.choice([["zzz"], [], ["some", "more"]])
                text = f"{prose(rng, 80)}\n{' '.join(some)}\n{prose(rng, 80)}"
                hits = [h for b, e in license_scan.blocks(text) for h in license_scan.scanned(text[b:e])]
                total += 1
                found += any(h[0] == name and h[5] == len(license_scan.words_of(t)) for h in hits)
    assert found >= 0.98 * total


def test_scan_equals_brute_force():
    """The best stretch of every template over all stretches of the whole text."""
    rng = random.Random(20)
    templates = [(name, license_scan.words_of(t)) for name, ts in license_scan.TEMPLATES.items() for t in ts if len(t) < 80]
    for name, words in templates * 2:
        some = list(words)
        if len(words) >= license_scan.LEAST_WORDS:
            some[rng.randrange(len(some))] = rng.choice(["zzz", "old"])
        text = f"{prose(rng, 12)} {' '.join(some)} {prose(rng, 12)}"
        block = license_scan.words_of(text)
        best = {}
        for other, t in templates:
            for i in range(len(block)):
                for j in range(max(i + 1, i + len(t) - 1), min(len(block), i + len(t) + 1) + 1):
                    if set(t) & set(block[i:j]):
                        n = len(license_scan.changes(t, block[i:j]).split())
                        least = license_scan.differences(t, block[i:j])
                        assert n >= least
                        short = len(t) < license_scan.LEAST_WORDS and not set(t) <= set(block[i:j])
                        if least <= license_scan.most_differences(len(t)) and not short:
                            best[other] = max(best.get(other, 0), len(t) - least)
        top = {k for k, v in best.items() if v == max(best.values())}
        hits = [(b + h[2], b + h[3], h) for b, e in license_scan.blocks(text) for h in license_scan.scanned(text[b:e])]
        assert name in top and top <= {h[0] for _, _, h in hits} <= set(best)
        for low, high, h in hits:
            assert license_scan.differences(license_scan.words_of(license_scan.TEMPLATES[h[0]][h[1]]), license_scan.words_of(text[low:high])) == h[6]


# --- Pipeline ----------------------------------------------------------------


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = labelled()
    rows += [(1000 + i, rows[i][1], rows[i][2], "s", 0, None, None, None) for i in range(30)]
    rows += [(2000, None, None, None, None, None, None, None), (2001, "12 34", "aa", "s", 0, None, None, None), (2002, "lorem ipsum", "aa", "s", 0, None, None, None)]
    docs = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        out = common.written(stage(spark, docs, str(tmp_path)), name)
        before, after = Counter(r.doc_id for r in docs.collect()), Counter(r.doc_id for r in out.collect())
        if name == "language":
            assert set(before) - set(after) == {2000, 2001}
        elif name == "quality":
            kept = {r.doc_id for r in quality.judged(docs).collect() if r.kept}
            assert set(after) == kept
        elif name == "near_dedup":
            want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
            assert set(after) == {d for d, (_, c) in want.items() if d == c}
        else:
            assert set(after) == set(before)
            columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert sorted(out.columns) == sorted(columns)
        docs = out


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path):
    for n, docs in enumerate((table(spark), empty(spark))):
        for _, stage in corpus_pipeline.STAGES:
            docs = common.written(stage(spark, docs, str(tmp_path)), "stage")
        assert (docs.count() > 0) == (n == 0)


# --- Patterned texts ---------------------------------------------------------


def test_patterned_texts_are_told_apart(spark):
    for n in (1024, 2048, 4096):
        word = "".join("ab"[i.bit_count() & 1] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        found = quality.counts([f"{word}\n{other}", f"{word}\n{word}"])
        assert found["n_dup_lines"].tolist() == [0, 1]
        a, b = fingerprints.signatures([word, other])
        assert (a != b).any()
        hashes, bounds = near_dedup.sets([word, other])
        assert bounds.tolist() == [0, 1, 2] and hashes[0] != hashes[1]
    docs = spark.createDataFrame([(0, word), (1, other), (2, word)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.linked(docs).collect()} == {0: 0, 1: 1, 2: 0}
