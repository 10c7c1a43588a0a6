"""Chat formatting: roles of raw transcripts recovered by a hidden Markov model.

A raw transcript is lines of text; turns may be parted by a blank line, and a
turn may begin with a speaker marker or without one.  The hidden states are, for
each role, the first line of a turn (FIRST), its further lines (FURTHER) and the
blank line between it and the next turn (GAP).  What is seen of a line is the
word of its speaker marker, if it has one of the known forms, and its length
class; words are hashed into WORDS classes, so the alphabet is bounded whatever
the texts hold.  Start, transition and emission probabilities are counted from
labelled lines, with additive smoothing.  The Viterbi path gives each line its
role and tells where turns begin, from markers where there are any and else from
the order of roles, gaps and lengths; turns are then rendered in one canonical
form.  A marker is cut from a turn's first line if its word begins at least
SPEAKER_SHARE of the labelled turns.

A transcript may be as long as it likes, and so may a turn: lines are counted in
pieces of a turn, the counts are summed up along the transcript, and lines are
dealt in blocks of about BLOCK lines by their place.  Viterbi is a product of
max-plus matrices: a first pass gives each block of a longer transcript its
matrix, a small table of matrices (one for each block of one transcript at a
time) is joined up in order, and a second pass decodes all blocks side by side,
each with the scores it begins with and the state it has to end in.

Defined cases: a null text is empty, a null role is the role `unknown`; rows with
a null conv_id are one transcript; a null turn comes before all others; rows that
are equal in conversation, turn, role and text are one; other rows of one turn
are lines of it, and lines with equal places are ordered by their text; roles
beyond the ROLES most frequent ones are `unknown`, so the tables of a model are
bounded; of paths with equal scores the one with the lower states is taken; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm import common

FIRST, FURTHER, GAP = range(3)
#: Lines in a block of a transcript, about.
BLOCK = 4096
SMOOTHING = 0.1
#: Roles that a model tells apart.
ROLES = 64
#: Turns whose pieces are summed up together.
TURNS = 1024
WORDS = 512
SPEAKER_SHARE = 0.01
#: Forms of speaker markers; the speaker's word, then the turn's text.
FORMS = [
    re.compile(r"(?:<\|(?P<a>[A-Za-z]{1,20})\|>)"),
    re.compile(r"(?:\[(?P<a>[A-Za-z]{1,20})\] ?)"),
    re.compile(r"(?:#{1,6} (?P<a>[A-Za-z]{1,20})$)"),
    re.compile(r"(?:(?P<a>[A-Z][A-Za-z]{0,19}): ?)"),
]
OWN_LINE = 2  # the form that fills a line; its text begins on the next
#: Of the raw transcripts made here, one turn in so many has lost its marker.
UNMARKED = 3
OUT = "conv_id long, block long, turn long, line_no int, state int, line string"


def marker(line: str) -> tuple[str, int, int]:
    """(speaker's word, form, length of the marker); no word without a marker."""
    for i, form in enumerate(FORMS):
        m = form.match(line)
        if m:
            return m["a"].lower(), i, m.end()
    return "", -1, 0


def word_class(line: str) -> int:
    """The class of the speaker's word; -1 without a marker."""
    word = marker(line)[0]
    return zlib.crc32(word.encode()) % WORDS if word else -1


def symbol(line: str) -> str:
    """Word class and length class: blank, or the number of binary digits of a sixteenth of the length, 7 at most."""
    return f"{word_class(line)}/{min(7, (len(line) // 16).bit_length()) if line.strip() else 'blank'}"


@dataclass
class Model:
    """Log probabilities; state 3k + part, with the parts FIRST, FURTHER, GAP of a turn of role k."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    emit: dict[str, np.ndarray]
    other: np.ndarray
    speakers: frozenset[int] = frozenset()

    def emission(self, line: str) -> np.ndarray:
        return self.emit.get(symbol(line), self.other)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which null keys are equal."""
    other = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, on, how).drop(*(f"_{k}" for k in keys))


def fitted(lines: DataFrame) -> Model:
    """A model counted from labelled lines (conv_id, turn, line_no, part, line, role), whole table.

    Counts are grouped before they reach the driver: one row for each pair of
    states and each state and symbol.
    """
    symbols = F.pandas_udf(lambda s: s.map(symbol), "string")
    role, turn = F.coalesce(F.col("role"), F.lit("unknown")), F.coalesce(F.col("turn"), F.lit(-1)).cast("long")
    often = [r["role"] for r in lines.groupBy(role.alias("role")).count().orderBy(F.desc("count"), "role").limit(ROLES + 1).collect()]
    if len(often) > ROLES:
        role = F.when(role.isin(often[: ROLES - 1]), role).otherwise("unknown")
    rows = lines.select("conv_id", turn.alias("turn"), "line_no", role.alias("role"), symbols("line").alias("symbol"), "part")
    seen = rows.groupBy("role", "part", "symbol").count().collect()
    of_part = [F.count(F.when(F.col("part") == part, 1)).alias(name) for part, name in ((FURTHER, "further"), (GAP, "gap"))]
    ends = rows.groupBy("conv_id", "turn").agg(F.min("role").alias("role"), *of_part)
    after = ends.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    last = F.when(F.col("gap") > 0, GAP).when(F.col("further") > 0, FURTHER).otherwise(FIRST)
    steps = _joined(ends, after, ["conv_id", "turn"]).groupBy("role", last.alias("last"), "next").count().collect()
    first_turn = ends.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role"))
    firsts = first_turn.groupBy("role").count().collect()
    long, gap = (F.col("further") > 0).cast("long"), (F.col("gap") > 0).cast("long")
    inside = ends.groupBy("role").agg(
        F.sum(long).alias("long"), F.sum(F.greatest(F.col("further") - 1, F.lit(0))).alias("inner"), F.sum(gap * long).alias("gap_long"), F.sum(gap * (1 - long)).alias("gap_short")
    )
    inside = inside.collect()
    roles = sorted({r["role"] for r in seen})
    at = {r: 3 * i for i, r in enumerate(roles)}
    size = 3 * len(roles)
    start, step = np.full(size, 1e-9), np.full((size, size), 1e-12)
    start[FIRST::3] = SMOOTHING
    for i in range(0, size, 3):  # a line goes on with its own turn, or a turn begins
        step[i : i + 3, FIRST::3] = SMOOTHING
        step[i : i + 2, [i + FURTHER, i + GAP]] = SMOOTHING
    for r in firsts:
        start[at[r["role"]]] += r["count"]
    for r in steps:
        step[at[r["role"]] + r["last"], at[r["next"]]] += r["count"]
    for r in inside:
        i = at[r["role"]]
        step[i, i + FURTHER] += r["long"]
        step[i + FURTHER, i + FURTHER] += r["inner"]
        step[i + FURTHER, i + GAP] += r["gap_long"]
        step[i, i + GAP] += r["gap_short"]
    emit = {s: np.full(size, SMOOTHING) for s in sorted({r["symbol"] for r in seen})}
    words: dict[int, int] = {}
    for r in seen:
        emit[r["symbol"]][at[r["role"]] + r["part"]] += r["count"]
        if r["part"] == FIRST:
            word = int(r["symbol"].split("/")[0])
            words[word] = words.get(word, 0) + r["count"]
    speakers = frozenset(w for w, n in words.items() if w >= 0 and n >= SPEAKER_SHARE * sum(words.values()))
    total = sum(emit.values(), np.full(size, SMOOTHING))
    if not roles:
        return Model([], start, step, {}, total)
    return Model(roles, np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), {s: np.log(e / total) for s, e in emit.items()}, np.log(SMOOTHING / total), speakers)


def transfer(model: Model, lines: list[str], first: bool) -> np.ndarray:
    """Max-plus matrix of a block: best score from the state before it to the state at its end; first: rows are equal, from the start."""
    out = None
    for line in lines:
        e = model.emission(line)
        if out is None:
            out = (np.tile(model.start, (len(e), 1)) if first else model.step) + e
        else:
            out = (out[:, :, None] + model.step[None]).max(1) + e
    return out


def viterbi(model: Model, lines: list[str], before: np.ndarray | None, end: int = -1) -> np.ndarray:
    """States of the lines; before: scores of the states before them, none at the start of a transcript."""
    back = np.zeros((len(lines), len(model.start)), np.int64)
    score = None
    for i, line in enumerate(lines):
        e = model.emission(line)
        if score is None and before is None:
            score = model.start + e
        else:
            paths = (before if score is None else score)[:, None] + model.step
            back[i] = paths.argmax(0)
            score = paths.max(0) + e
    out = np.zeros(len(lines), np.int64)
    out[-1] = end if end >= 0 else int(score.argmax())
    for i in range(len(lines) - 1, 0, -1):
        out[i - 1] = back[i][out[i]]
    return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (conv_id, block), which are adjacent."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key is not None and row[:2] != key:
                yield key, held
                held = []
            key = row[:2]
            held.append(row)
    if key is not None:
        yield key, held


def parsed(lines: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """OUT: lines (conv_id, turn, line_no, line) with their states; turn and line_no give their order only."""
    if not model.roles:
        return lines.sparkSession.createDataFrame([], OUT)
    spark = lines.sparkSession
    turn = F.coalesce(F.col("turn"), F.lit(-1)).cast("long")
    rows = lines.select(F.col("conv_id").cast("long"), turn.alias("turn"), F.col("line_no").cast("int"), "line").withColumn("piece", F.floor(F.col("line_no") / block))
    rows = common.written(rows, "rows")
    counts = rows.groupBy("conv_id", "turn", "piece").agg(F.count(F.lit(1)).alias("here")).withColumn("turns", F.floor(F.col("turn") / TURNS))
    of_turns = counts.groupBy("conv_id", "turns").agg(F.sum("here").alias("sum"))
    of_turns = of_turns.select("conv_id", "turns", F.coalesce(F.sum("sum").over(W.partitionBy("conv_id").orderBy("turns").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("here").over(W.partitionBy("conv_id", "turns").orderBy("turn", "piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = _joined(counts.withColumn("within", within), of_turns, ["conv_id", "turns"])
    # A piece of a turn is a block's lines at most, so no key of this join is hot, and no block has more than two blocks' lines.
    starts = starts.select("conv_id", "turn", "piece", F.floor((F.col("before") + F.col("within")) / block).alias("block"))
    placed = _joined(rows, starts, ["conv_id", "turn", "piece"]).select("conv_id", "block", "turn", "line_no", "line")
    parts = common.shuffle_partitions(spark)
    dealt = common.written(placed.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "line_no", "line"), "lines")
    common.dropped(rows)
    longer = common.written(dealt.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).where("low <> high"), "longer")
    size = len(model.start)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, at), held in _grouped(batches):
            matrix = transfer(model, [r[4] for r in held], held[0][5])
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([at], pa.int64()), pa.array([matrix.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["conv_id", "block", "matrix"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(conv, blocks):
            scores, entering = None, []
            for _, matrix in blocks:
                entering.append(scores)
                scores = matrix[0] if scores is None else (scores[:, None] + matrix).max(0)
            ends = [int(scores.argmax())]
            for (_, matrix), enter in zip(blocks[:0:-1], entering[:0:-1], strict=True):
                ends.append(int((enter + matrix[:, ends[-1]]).argmax()))
            ends.reverse()
            return pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(blocks), pa.int64()), pa.array([b for b, _ in blocks], pa.int64()), pa.array([None if e is None else e.tolist() for e in entering], pa.list_(pa.float64())), pa.array(ends, pa.int32())],
                names=["conv_id", "block", "enter", "finish"],
            )

        conv, held = None, []
        for batch in batches:
            for c, b, m in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if held and c != conv:
                    yield flush(conv, held)
                    held = []
                conv = c
                held.append((b, np.array(m).reshape(size, size)))
        if held:
            yield flush(conv, held)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _grouped(batches):
            enter, finish = held[0][5], held[0][6]
            states = viterbi(model, [r[4] for r in held], None if enter is None else np.array(enter), -1 if finish is None else finish)
            columns = list(zip(*held, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()), pa.array(states.astype(np.int32)), pa.array(columns[4], pa.string())],
                names=["conv_id", "block", "turn", "line_no", "state", "line"],
            )

    ordered = ["conv_id", "block", "turn", "line_no", "line"]
    long_lines = _joined(dealt, longer, ["conv_id"]).select(*ordered, (F.col("block") == F.col("low")).alias("first"))
    by_block = long_lines.repartition(parts, "conv_id", "block").sortWithinPartitions(*ordered).mapInArrow(matrices, "conv_id long, block long, matrix array<double>")
    edges = common.written(by_block.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(chained, "conv_id long, block long, enter array<double>, finish int"), "edges")
    bounded = _joined(dealt, edges, ["conv_id", "block"], "left").select(*ordered, "enter", "finish")
    return bounded.repartition(parts, "conv_id", "block").sortWithinPartitions(*ordered).mapInArrow(decode, OUT)


def rendered(states: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn (from 0), role, rendered: each recovered turn in canonical form."""
    states = common.written(states.where(F.col("state") % 3 != GAP), "states")
    begins = (F.col("state") % 3 == FIRST).cast("long")
    in_block = W.partitionBy("conv_id", "block").orderBy("turn", "line_no", "line")
    of_block = states.groupBy("conv_id", "block").agg(F.sum(begins).alias("here"))
    ahead = of_block.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), (F.sum("here").over(W.partitionBy("conv_id").orderBy("block")) - F.col("here")).alias("ahead"))
    roles = F.array(*(F.lit(r) for r in model.roles)) if model.roles else F.array(F.lit("unknown"))
    rows = (
        states.withColumn("nth", F.sum(begins).over(in_block.rowsBetween(W.unboundedPreceding, 0)))
        .join(ahead, (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("block").eqNullSafe(F.col("b"))))
        .withColumn("place", F.col("nth") + F.col("ahead") - 1)
    )

    speakers = model.speakers

    @F.pandas_udf("struct<text: string, skipped: boolean>")
    def content(line, state):
        import pandas as pd

        out = []
        for text, s in zip(line, state, strict=True):
            _, form, size = marker(text) if s % 3 == FIRST and word_class(text) in speakers else ("", -1, 0)
            out.append((text[size:], form == OWN_LINE))
        return pd.DataFrame(out, columns=["text", "skipped"])

    lines = rows.withColumn("c", content("line", "state")).where("not c.skipped")
    turns = rows.where(F.col("state") % 3 == FIRST).select("conv_id", "place", roles[F.floor(F.col("state") / 3).cast("int")].alias("role"))
    texts = lines.groupBy("conv_id", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line_no", F.col("c.text").alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    return _joined(turns, texts, ["conv_id", "place"], "left").select("conv_id", F.col("place").alias("turn"), "role", F.concat(head, F.coalesce("text", F.lit("")), F.lit("\n<|end|>")).alias("rendered"))


def raw_lines(turns: DataFrame, unmarked: int = UNMARKED) -> DataFrame:
    """Lines of raw transcripts of turns (conv_id, turn, role, text), labelled: conv_id, turn, line_no, part, line, role.

    Rows that repeat are taken once.  Turns are parted by blank lines and marked
    in one of four styles by conversation; one in `unmarked` turns, by a hash of its place, has lost its
    marker (0: none).
    """
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    style = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(4))
    bare = (F.pmod(F.xxhash64("conv_id", "turn", F.lit(5)), F.lit(unmarked)) == 0) if unmarked else F.lit(False)
    speaker: Column = F.initcap(role)
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = (
        F.when(bare, text)
        .when(style == 0, F.concat(speaker, F.lit(": "), text))
        .when(style == 1, F.concat(F.lit("### "), speaker, F.lit("\n"), text))
        .when(style == 2, F.concat(F.lit("["), F.upper(role), F.lit("] "), text))
        .otherwise(F.concat(F.lit("<|"), role, F.lit("|>"), text))
    )
    lines = F.transform(F.split(whole, "\n", -1), lambda line, i: F.struct(F.when(i == 0, FIRST).otherwise(FURTHER).alias("part"), line.alias("line")))
    gap = F.array(F.struct(F.lit(GAP).alias("part"), F.lit("").alias("line")))
    return turns.select("conv_id", "turn", "role", "text").distinct().select("conv_id", "turn", role.alias("role"), F.posexplode(F.concat(lines, gap)).alias("line_no", "_line")).select("conv_id", "turn", "line_no", "_line.part", "_line.line", "role")


def held_out() -> Column:
    """Conversations that no model is counted from."""
    return F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transcripts of all conversations, a third of their turns without a marker, recovered by a model counted from those not held out."""
    lines = raw_lines(common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    model = fitted(lines.where(~held_out()))
    return rendered(parsed(lines.drop("role", "part"), model), model).withColumn("held_out", held_out())
