"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of WINDOW bytes, all of them.  Two
gated recurrent layers (GRU), one from the left and one from the right, read
each window; a softmax over both states gives language probabilities at every
byte, which are averaged over the document.  The best language is the
prediction, its average the score.

The network is trained here, in numpy, by backpropagation through time with
Adam, every byte of a training window carrying the label of its document.
Training rows are a bounded sample: PER_LABEL documents of each label, fewer of
each if that makes more than SAMPLE documents in all, but at least one; WINDOWS
windows of each.  Every label is learned.  Ids, sources and labels are never
inputs.  Prediction reads the whole of every text, in one pass without a
shuffle; the model (about 60 kB with a few labels) travels with the task.

As a filter, a text goes if it has no letters, if its language is not one of
those expected, or if its score is under the model's floor.  That is LIFT of the
way from a blind guess among its labels to certainty, but no more than what all
but FLOOR_SHARE of the sample windows score; a whole text has more bytes to pool
than a window, so clean texts stay, however many labels share the probability.

Defined cases: `und` with score 0 for a null text, a text without a letter, or
if no row is labelled (a filter then keeps all texts with letters); a very long
text is pooled over all its windows; equal probabilities give the label that
comes first in order; rows without a label or id are not trained on; repeated
rows are drawn once and predicted alike; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm import common
from spanforge.llm import textbatch as tb
from spanforge.llm.pretoken import LETTER, classes

WINDOW = 64
HIDDEN = 8
PER_LABEL, SAMPLE, WINDOWS = 400, 25_600, 3
FLOOR_SHARE, LIFT = 0.01, 0.2
BROADCAST_LABELS = 50_000
EPOCHS, BATCH, RATE = 10, 256, 0.02
SEED = 1
UNKNOWN = "und"


@dataclass
class Layer:
    """Input rows of the gates (update and reset; candidate) by byte, and recurrent weights."""

    gates_in: np.ndarray  # 256 x 2H
    cand_in: np.ndarray  # 256 x H
    gates: np.ndarray  # H x 2H
    cand: np.ndarray  # H x H


@dataclass
class Model:
    labels: list[str]
    layers: tuple[Layer, Layer]  # from the left, from the right
    out: tuple[np.ndarray, np.ndarray]  # H x labels, for each layer
    bias: np.ndarray
    floor: float = 0.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _step(layer: Layer, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(update and reset gates, recurrent part of the candidate, candidate, new state)."""
    size = h.shape[1]
    gates = layer.gates_in[x]
    gates += h @ layer.gates
    gates = _sigmoid(gates)
    held = h @ layer.cand
    new = held * gates[:, size:]
    new += layer.cand_in[x]
    new *= 2
    new = _sigmoid(new)  # tanh by the logistic function
    new *= 2
    new -= 1
    state = h - new
    state *= gates[:, :size]
    state += new
    return gates, held, new, state


def probabilities(model: Model, windows: np.ndarray) -> np.ndarray:
    """windows (WINDOW x n bytes) to probabilities (WINDOW x labels x n).

    Each number of a state is a row over all windows, so that all work is on
    long rows; signs and factors of the logistic functions are in the weights.
    """
    steps, n = windows.shape
    windows = windows.astype(np.intp)
    logits = np.empty((steps, len(model.labels), n), np.float32)
    logits[:] = model.bias[:, None]
    for layer, out, order in ((model.layers[0], model.out[0], range(steps)), (model.layers[1], model.out[1], range(steps - 1, -1, -1))):
        size = out.shape[0]
        scale = np.repeat(np.float32([-1, -2]), [2 * size, size])[:, None]
        table = np.ascontiguousarray(np.concatenate([layer.gates_in, layer.cand_in], 1).T * scale)
        weights = np.ascontiguousarray(np.concatenate([layer.gates, layer.cand], 1).T * scale)
        to_labels = np.ascontiguousarray(out.T)
        h, past, x = np.zeros((size, n), np.float32), np.empty((3 * size, n), np.float32), np.empty((3 * size, n), np.float32)
        gates, new = x[: 2 * size], x[2 * size :]
        with np.errstate(over="ignore"):
            for t in order:
                np.take(table, windows[t], axis=1, out=x, mode="clip")
                np.matmul(weights, h, out=past)
                gates += past[: 2 * size]
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new += past[2 * size :] * gates[size:]
                np.exp(new, out=new)
                new += 1
                np.divide(2, new, out=new)
                new -= 1
                h -= new
                h *= gates[:size]
                h += new
                logits[t] += to_labels @ h
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def _gradients(model: Model, windows: np.ndarray, labels: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over all bytes inside, in the order of _weights()."""
    steps, n = windows.shape
    tapes, logits = [], np.zeros((steps, n, len(model.labels)), np.float32) + model.bias
    for layer, out, order in ((model.layers[0], model.out[0], range(steps)), (model.layers[1], model.out[1], range(steps - 1, -1, -1))):
        h, tape = np.zeros((n, out.shape[0]), np.float32), []
        for t in order:
            gates, held, new, state = _step(layer, windows[t], h)
            tape.append((t, h, gates, held, new, state))
            logits[t] += state @ out
            h = state
        tapes.append(tape)
    logits -= logits.max(2, keepdims=True)
    error = np.exp(logits)
    error /= error.sum(2, keepdims=True)
    error[:, np.arange(n), labels] -= 1
    error *= (inside / max(1, inside.sum()))[:, :, None]
    found: list[np.ndarray] = []
    for layer, out, tape in zip(model.layers, model.out, tapes, strict=True):
        size = out.shape[0]
        d_out, d_gates, d_cand = np.zeros_like(out), np.zeros_like(layer.gates), np.zeros_like(layer.cand)
        d_gates_in, d_cand_in = np.zeros_like(layer.gates_in), np.zeros_like(layer.cand_in)
        d_next = np.zeros((n, size), np.float32)
        for t, h, gates, held, new, state in reversed(tape):
            update, reset = gates[:, :size], gates[:, size:]
            d_out += state.T @ error[t]
            d = d_next + error[t] @ out.T
            d_new = d * (1 - update) * (1 - new * new)
            d_both = np.concatenate([d * (h - new), d_new * held], 1) * gates * (1 - gates)
            d_held = d_new * reset
            d_gates += h.T @ d_both
            d_cand += h.T @ d_held
            d_next = d * update + d_both @ layer.gates.T + d_held @ layer.cand.T
            np.add.at(d_gates_in, windows[t], d_both)
            np.add.at(d_cand_in, windows[t], d_new)
        found += [d_gates_in, d_cand_in, d_gates, d_cand, d_out]
    return [*found, error.sum((0, 1))]


def _weights(model: Model) -> list[np.ndarray]:
    out = []
    for layer, o in zip(model.layers, model.out, strict=True):
        out += [layer.gates_in, layer.cand_in, layer.gates, layer.cand, o]
    return [*out, model.bias]


def windows_of(raws: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(all windows of the raw texts, window x n, filled up with 0 bytes; number of windows of each text)."""
    sizes = np.array([len(r) for r in raws], np.int64)
    number = -(-sizes // window)
    begin = tb.bounds_of(number)
    flat = np.zeros(int(begin[-1]) * window, np.uint8)
    joined = np.frombuffer(b"".join(raws), np.uint8)
    flat[np.arange(len(joined)) + np.repeat(begin[:-1] * window - tb.bounds_of(sizes)[:-1], sizes)] = joined
    return np.ascontiguousarray(flat.reshape(-1, window).T), number


def trained(samples: list[tuple[str, str]], epochs: int = EPOCHS, hidden: int = HIDDEN, seed: int = SEED) -> Model:
    """A model from (window text, label) samples."""
    labels = sorted({label for _, label in samples})
    rng = np.random.Generator(np.random.PCG64(seed))

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    layers = tuple(Layer(drawn(256, 2 * hidden, scale=0.1), drawn(256, hidden, scale=0.3), drawn(hidden, 2 * hidden, scale=0.3), drawn(hidden, hidden, scale=0.3)) for _ in range(2))
    for layer in layers:
        layer.gates_in[:, :hidden] += 1  # states are kept for long at first
    model = Model(labels, layers, tuple(drawn(hidden, len(labels), scale=0.1) for _ in range(2)), np.zeros(len(labels), np.float32))
    if len(labels) < 2:
        return model
    number = {label: i for i, label in enumerate(labels)}
    raws = [text.encode()[:WINDOW] for text, _ in samples]
    windows = np.zeros((WINDOW, len(raws)), np.uint8)
    for i, raw in enumerate(raws):
        windows[: len(raw), i] = np.frombuffer(raw, np.uint8)
    inside = np.arange(WINDOW)[:, None] < np.array([len(r) for r in raws])[None]
    target = np.array([number[label] for _, label in samples])
    weights = _weights(model)
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * -(-len(raws) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(raws))
        for b in range(0, len(raws), BATCH):
            at = order[b : b + BATCH]
            step += 1
            rate = RATE * (1 - 0.95 * step / total)
            for w, g, m, s in zip(weights, _gradients(model, windows[:, at], target[at], inside[:, at]), mean, square, strict=True):
                np.clip(g, -1, 1, out=g)
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def predicted(model: Model, texts: list[str | None], block: int = 2048) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, share of positions labelled so) of each text."""
    best, score, share = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if not model.labels:
        return best, score, share
    letters = classes()
    asked = [i for i, t in enumerate(texts) if t and (letters[tb.code_points(t)] == LETTER).any()]
    raws = [texts[i].encode() for i in asked]
    if not raws:
        return best, score, share
    windows, number = windows_of(raws)
    block = max(1, min(block, block * 8 // len(model.labels)))  # logits of a block stay as small with many labels
    sums, votes = np.zeros((windows.shape[1], len(model.labels))), np.zeros((windows.shape[1], len(model.labels)))
    size = np.full(windows.shape[1], WINDOW)
    size[np.cumsum(number) - 1] = [(len(r) - 1) % WINDOW + 1 for r in raws]
    for b in range(0, windows.shape[1], block):
        p = probabilities(model, windows[:, b : b + block])
        part = slice(b, b + block)
        if (size[part] < WINDOW).any():
            p *= (np.arange(WINDOW)[:, None] < size[part][None])[:, None]
        top = p == p.max(1, keepdims=True)
        top &= p > 0
        sums[part], votes[part] = p.sum(0).T, top.sum(0).T
    cuts = np.cumsum(number) - number
    length = np.array([len(r) for r in raws])[:, None]
    pooled, voted = np.add.reduceat(sums, cuts, axis=0) / length, np.add.reduceat(votes, cuts, axis=0) / length
    which = pooled.argmax(1)
    for k, i in enumerate(asked):
        best[i] = model.labels[which[k]]
    score[asked] = np.clip(pooled[np.arange(len(asked)), which], 0, 1)
    share[asked] = np.clip(voted[np.arange(len(asked)), which], 0, 1)
    return best, score, share


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def floor_of(model: Model, samples: list[tuple[str, str]]) -> float:
    """LIFT of the way from a blind guess to certainty, or the score that all but FLOOR_SHARE of the sample windows reach if that is less."""
    if not samples or not model.labels:
        return 0.0
    _, score, _ = predicted(model, [text for text, _ in samples])
    guess = 1 / len(model.labels)
    return min(guess + LIFT * (1 - guess), float(np.quantile(score[score > 0], FLOOR_SHARE)) if score.any() else 0.0)


def fitted(docs: DataFrame, per_label: int = PER_LABEL, sample: int = SAMPLE, windows: int = WINDOWS) -> Model:
    """A model from the labelled rows of docs (doc_id, text, lang) that are not held out; see the module's text for the bounds."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    # Copies of a row have one draw; the least one of each label is always in.
    rows = rows.withColumn("_draw", F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 40)))
    counts = rows.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_draw").alias("_least"))
    labels = counts.count()
    if not labels:
        return trained([])
    per_label = max(1, min(per_label, sample // labels))
    # About twice as many rows as wanted pass the first draw; a label of few rows passes whole.
    share = F.least(F.lit(1.0), F.lit(2.0 * per_label + 20) / F.col("_rows"))
    if labels <= BROADCAST_LABELS:  # counted; the model on the driver has a row for each as well
        counts = F.broadcast(counts)
    passed = rows.join(counts, F.col("lang") == F.col("_lang")).where((F.col("_draw") < share * float(1 << 40)) | (F.col("_draw") == F.col("_least")))
    span = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    starts = [F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED + 1 + k)), span).cast("int") + 1 for k in range(windows)]
    cut = [F.substring(F.col("text"), s, F.lit(WINDOW)).alias(f"w{k}") for k, s in enumerate(starts)]
    once = passed.select("lang", "_draw", *cut).dropDuplicates(["lang", "_draw"])
    best = once.withColumn("_place", F.row_number().over(W.partitionBy("lang").orderBy("_draw"))).where(F.col("_place") <= per_label)
    samples = [(r[f"w{k}"], r["lang"]) for r in sorted(best.collect(), key=lambda r: (r["lang"], r["_draw"])) for k in range(windows)]
    model = trained(samples)
    model.floor = floor_of(model, samples)
    return model


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, position_share of each row of docs (doc_id, text)."""

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for b, e in common.slices([t or "" for t in texts]):
                best, score, share = predicted(model, texts[b:e])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b, e - b), pa.array(best), pa.array(score), pa.array(share)], names=["doc_id", "lang_pred", "score", "position_share"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, position_share double")


def accepted(docs: DataFrame, model: Model, languages: list[str] | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is told, is one of languages (None: any learned one) and reaches the model's floor."""
    at = docs.columns.index("text")
    expected = {x for x in model.labels if languages is None or x in languages}

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for b, e in common.slices([t or "" for t in texts]):
                if model.labels:
                    best, score, _ = predicted(model, texts[b:e])
                    kept = np.array([x in expected for x in best], bool) & (score >= model.floor)
                else:  # nothing to tell languages by
                    kept = np.array([bool(t) and bool((classes()[tb.code_points(t)] == LETTER).any()) for t in texts[b:e]], bool)
                yield batch.slice(b, e - b).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return identified(docs, fitted(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "position_share")
