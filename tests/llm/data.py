"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rank int, bin long"


def prose(rng: random.Random, words: int, vocabulary: int = 3000) -> str:
    out = []
    while words > 0:
        n = min(words, rng.randint(4, 14))
        out.append(" ".join("".join(rng.choice("aeioustrnlm") for _ in range(rng.randint(2, 8))) for _ in range(n)) + ".")
        words -= n
    return "\n".join(out)


def awkward(rng: random.Random | None = None) -> list[tuple]:
    rng = rng or random.Random(7)
    base = prose(rng, 120)
    words = base.split(" ")
    near = " ".join(["changed", *words[1:]])
    texts = [base, base, near, None, "", "   \n", "Hi", "one two three", prose(rng, 6000), "word " * 400, "é😀 漢字 <|endoftext|> it's\r\n\tx", "12 34 !!", "A" * 5000, base.upper()]
    rows = [(i, t, "en" if i % 2 else None, "host" if i % 3 else None, None, True, 1, 2) for i, t in enumerate(texts)]
    return [*rows, (1, base, "en", "host", None, None, None, None), (None, "no id here at all, but some words", "en", None, None, None, None, None)]


def table(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows.collect()), key=repr)
