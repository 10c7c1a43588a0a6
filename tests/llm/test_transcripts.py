from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from spanforge.llm import catalogue, common, transcripts
from tests.llm.data import plain_rows, prose
from tests.oracle import compare


def conversation(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, line string")


def talk(n_convs=40, turns=6):
    rng = random.Random(1)
    return [(c, t, ["system", "user", "assistant"][0 if t == 0 and c % 3 == 0 else 1 + t % 2], prose(rng, rng.randint(3, 40))) for c in range(n_convs) for t in range(turns)]


def want(rows):
    out = []
    for conv in {r[0] for r in rows}:
        for n, (_, _, role, text) in enumerate(sorted(r for r in rows if r[0] == conv)):
            out.append((conv, n, role, f"<|{role}|>\n{text}\n<|end|>"))
    return sorted(out)


def test_roles_are_recovered_in_every_style(spark):
    rows = talk()
    lines = transcripts.raw_lines(conversation(spark, rows), unmarked=0)
    model = transcripts.fitted(lines)
    assert sorted(map(tuple, transcripts.rendered(transcripts.parsed(lines.drop("role"), model), model).collect())) == want(rows)


def test_unmarked_turns_of_held_out_conversations_are_recovered(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "conversations")
    truth = {(r.conv_id, n): r.role for n, r in _numbered(docs.collect())}
    got = transcripts.query(spark, "/root/testdata/sf0.01").where("held_out").collect()
    bare = {(r.conv_id, r.turn) for r in docs.where(F.pmod(F.xxhash64("conv_id", "turn", F.lit(5)), F.lit(transcripts.UNMARKED)) == 0).collect()}
    mine = {(r.conv_id, r.turn): r for r in got}
    asked = [k for k in truth if zlib.crc32(str(k[0]).encode()) % 4 == 2]
    lost = [k for k in asked if k in bare]
    assert len(lost) > 20 and len(mine) == len(got)
    assert np.mean([k in mine and mine[k].role == truth[k] for k in asked]) >= 0.97
    assert np.mean([k in mine and mine[k].role == truth[k] for k in lost]) >= 0.9
    texts = {(r.conv_id, n): r.text for n, r in _numbered(docs.collect())}
    assert np.mean([k in mine and mine[k].rendered == f"<|{truth[k]}|>\n{texts[k]}\n<|end|>" for k in asked]) >= 0.97
    # Without the chain (all steps and starts alike) roles of unmarked turns cannot be told.
    lines = transcripts.raw_lines(docs)
    model = transcripts.fitted(lines.where(~transcripts.held_out()))
    model.step[:], model.start[:] = 0.0, 0.0
    flat = {(r.conv_id, r.turn): r.role for r in transcripts.rendered(transcripts.parsed(lines.drop("role", "part"), model), model).collect()}
    assert np.mean([flat.get(k) == truth[k] for k in lost]) < np.mean([k in mine and mine[k].role == truth[k] for k in lost]) - 0.1


def _numbered(rows):
    out, at = [], {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        out.append((at.setdefault(r.conv_id, 0), r))
        at[r.conv_id] += 1
    return out


def test_symbols_are_bounded(spark):
    rows = [(i, 0, "user", f"W{chr(97 + i % 26)}{chr(97 + i // 26)}x: said") for i in range(650)]
    model = transcripts.fitted(transcripts.raw_lines(conversation(spark, rows), unmarked=1))
    assert len(model.emit) <= 9 * (transcripts.WORDS + 1) and len({s.split("/")[0] for s in model.emit}) <= transcripts.WORDS + 1
    assert not model.speakers or len(model.speakers) < 100


def test_one_very_long_turn_is_dealt_in_blocks(spark):
    rows = [*talk(8), (50, 0, "user", "\n".join(f"line {i}" for i in range(3000))), (50, 1, "assistant", "and so on"), (50, None, "system", "before all")]
    lines = transcripts.raw_lines(conversation(spark, rows), unmarked=0)
    model = transcripts.fitted(lines)
    parsed = transcripts.parsed(lines.drop("role"), model, block=64)
    assert max(r["count"] for r in parsed.groupBy("conv_id", "block").count().collect()) <= 128
    assert parsed.where("conv_id = 50").select("block").distinct().count() > 20
    got = sorted((r.turn, r.role, r.rendered) for r in transcripts.rendered(parsed, model).where("conv_id = 50").collect())
    assert got == [(0, "system", "<|system|>\nbefore all\n<|end|>"), (1, "user", f"<|user|>\n{rows[-3][3]}\n<|end|>"), (2, "assistant", "<|assistant|>\nand so on\n<|end|>")]


def test_a_table_taken_twice_gives_the_same_turns(spark):
    rows = [*talk(12), (60, 0, "user", "same"), (60, 0, "user", "same"), (60, 1, "assistant", "reply"), (None, 0, "user", "no id"), (None, 1, "assistant", "here")]
    once = transcripts.raw_lines(conversation(spark, rows))
    model = transcripts.fitted(once)
    twice = transcripts.raw_lines(conversation(spark, rows + rows))
    same = transcripts.fitted(twice)
    assert same.roles == model.roles and np.allclose(same.step, model.step)
    got = [plain_rows(transcripts.rendered(transcripts.parsed(x.drop("role"), model), model)) for x in (once, twice)]
    assert got[0] == got[1] and all(r[3].split("\n")[1] for r in got[0])
    marked = transcripts.raw_lines(conversation(spark, rows + rows), unmarked=0)
    turns = transcripts.rendered(transcripts.parsed(marked.drop("role"), model), model).where("conv_id = 60").orderBy("turn").collect()
    assert [(r.turn, r.role, r.rendered.split("\n")[1]) for r in turns] == [(0, "user", "same"), (1, "assistant", "reply")]


def test_many_roles_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "ROLES", 3)
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for i in range(5) for t in range(4)] + [(9, t, f"guest{t}", "hello") for t in range(6)]
    model = transcripts.fitted(transcripts.raw_lines(conversation(spark, rows)))
    assert model.roles == ["assistant", "unknown", "user"] and model.step.shape == (9, 9)


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    size = 6
    emit = {s: np.log(rng.random(size)) for s in ("-1/0", f"{transcripts.word_class('User: x')}/0", "-1/blank")}
    model = transcripts.Model(["a", "b"], np.log(rng.random(size)), np.log(rng.random((size, size))), emit, np.log(rng.random(size)))
    for _ in range(20):
        lines = [rng.choice(["x", "User: x", "", "other: y"]) for _ in range(4)]

        def score(path, lines=lines):
            return model.start[path[0]] + sum(model.emission(x)[s] for x, s in zip(lines, path, strict=True)) + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False))

        best = max(itertools.product(range(size), repeat=4), key=score)
        assert np.isclose(score(transcripts.viterbi(model, lines, None).tolist()), score(best))


def test_blocks_give_the_same_path(spark):
    rows = talk(6, 30)
    lines = transcripts.raw_lines(conversation(spark, rows), unmarked=0)
    model = transcripts.fitted(lines)
    whole = sorted(map(tuple, transcripts.parsed(lines.drop("role"), model).drop("block").collect()))
    parts = sorted(map(tuple, transcripts.parsed(lines.drop("role"), model, block=4).drop("block").collect()))
    assert whole == parts
    assert sorted(map(tuple, transcripts.rendered(transcripts.parsed(lines.drop("role"), model, block=4), model).collect())) == want(rows)


def test_transfer_equals_viterbi():
    rng = np.random.default_rng(0)
    size = 4
    emit = {s: np.log(rng.random(size)) for s in ("-1/0", f"{transcripts.word_class('User: x')}/0")}
    model = transcripts.Model(["a", "b"], np.log(rng.random(size)), np.log(rng.random((size, size))), emit, np.log(rng.random(size)))
    lines = [rng.choice(["x", "User: x"]) for _ in range(12)]
    best = transcripts.viterbi(model, lines, None)
    score = model.start + model.emission(lines[0])
    total = score[best[0]] + sum(model.step[best[i - 1], best[i]] + model.emission(lines[i])[best[i]] for i in range(1, 12))
    assert np.isclose(total, transcripts.transfer(model, lines, True).max())


def test_awkward_conversations(spark):
    rows = [*talk(8), (100, 0, "user", None), (100, 1, "assistant", ""), (101, 0, None, "who"), (102, 0, "user", "\n\nlate\n"), (103, 0, "user", "long " * 5000)]
    lines = transcripts.raw_lines(conversation(spark, rows), unmarked=0)
    model = transcripts.fitted(lines)
    got = {(r.conv_id, r.turn): r.rendered for r in transcripts.rendered(transcripts.parsed(lines.drop("role"), model), model).collect()}
    assert got[100, 0] == "<|user|>\n\n<|end|>" and got[101, 0] == "<|unknown|>\nwho\n<|end|>"
    assert got[102, 0] == "<|user|>\n\n\nlate\n\n<|end|>" and got[103, 0].count("long") == 5000


def test_null_conv_id_is_one_transcript(spark):
    rows = talk(8)
    nulls = [(None, *r[1:]) for r in talk(1, 30)]
    lines = transcripts.raw_lines(conversation(spark, rows + nulls), unmarked=0)
    model = transcripts.fitted(lines)
    whole, parts = (transcripts.parsed(lines.drop("role"), model, block=b) for b in (256, 4))
    assert sorted(map(repr, whole.drop("block").collect())) == sorted(map(repr, parts.drop("block").collect()))
    for states in (whole, parts):
        got = sorted(tuple(r) for r in transcripts.rendered(states, model).where("conv_id is null").select("turn", "role", "rendered").collect())
        assert got == [r[1:] for r in want(nulls)]


def test_empty_conversations(spark):
    lines = transcripts.raw_lines(conversation(spark, []))
    model = transcripts.fitted(lines)
    assert transcripts.rendered(transcripts.parsed(lines.drop("role"), model), model).count() == 0


def test_queries_equal_their_sql(spark):
    for name, sql in catalogue.ORACLES.items():
        compare(spark, catalogue.QUERIES[name], sql)
