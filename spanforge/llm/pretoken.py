"""Pre-tokens of whole texts by array rules, and their token ids through a table of the pre-tokens met so far.

Byte-pair encoding never merges across pre-tokens, so the ids of a text are the
ids of its pre-tokens in a row.  A batch is cut into pre-tokens with class
tables and comparisons of neighbouring code points; each distinct pre-token is
encoded once by the encoder that is handed in, and the ids of the whole batch
are gathered from the table.  Hashes group equal pre-tokens of a batch, and each
pre-token is then compared with the one that stands for its group; the table is
keyed by the pre-tokens themselves, so ids never rest on a hash.  The table is
emptied when it holds too many.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd

from spanforge.llm import textbatch as tb

#: Classes of code points; END parts texts in a batch.
OTHER, LETTER, NUMBER, BLANK, SPACE, END = range(6)
#: The white space of Unicode (White_Space).
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, np.uint8)
    for block in range(0, 0x110000, 0x10000):
        chars = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(block, block + 0x10000))
        for kind, name in ((LETTER, "L"), (NUMBER, "N")):
            for m in regex.finditer(rf"\p{{{name}}}+", chars):
                table[block + m.start() : block + m.end()] = kind
        for m in re.finditer("[^\0]", chars):  # code points newer than the tokenizers library's tables
            if table[block + m.start()] and unicodedata.category(m.group()) == "Cn":
                table[block + m.start()] = OTHER
    table[WHITE] = BLANK
    table[0x20] = SPACE
    return table


def _cuts(codes: np.ndarray, kinds: np.ndarray, joins_space: bool, single_numbers: bool) -> np.ndarray:
    """Where pre-tokens begin. kinds has END before the first and after each text."""
    group = np.where(kinds == SPACE, np.uint8(BLANK), kinds)
    blank = group == BLANK
    new = np.zeros(len(kinds), bool)
    new[1:] = group[1:] != group[:-1]
    if single_numbers:
        new |= kinds == NUMBER
    run_start = new.copy()
    if joins_space:
        new[1:] &= ~((kinds[:-1] == SPACE) & ~blank[1:] & (kinds[1:] != END))
        new[:-1] |= blank[:-1] & ~blank[1:] & (kinds[1:] != END)
        run_start = new
    quote = np.flatnonzero((codes == 39) & run_start)
    if len(quote):
        quote = quote[quote + 3 < len(codes)] if quote[-1] + 3 >= len(codes) else quote
        one, two = codes[quote + 1], codes[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        new[quote[short | long] + 1] = False
        new[quote[short] + 2] = True
        new[quote[long & ~short] + 3] = True
        new[quote[long & ~short] + 2] = False
    return new


class Vocabulary:
    """What a tokenizer file says, and the pre-tokens met so far with their ids.

    encode: ids of each of some pre-tokens (their text), in the order given.
    """

    def __init__(self, path: str, encode: Callable[[list[str]], list[list[int]]], most: int = 400_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.words_only = spec["normalizer"] is not None
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.encode, self.most = encode, most
        self._empty()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.begin, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.int32), 0

    def _places(self, pieces: list[str]) -> np.ndarray:
        """The table's row of each piece; new ones are encoded."""
        found = [self.place.get(p, -1) for p in pieces]
        if -1 in found:
            new = list(dict.fromkeys(p for p, at in zip(pieces, found, strict=True) if at < 0))
            ids = self.encode(new)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
            low, high, used = len(self.place), len(self.place) + len(new), self.used + len(flat)
            self.place.update(zip(new, range(low, high), strict=True))
            while high > len(self.begin):
                self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
            while used > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.begin[low:high], self.length[low:high] = self.used + np.cumsum(sizes) - sizes, sizes
            self.ids[self.used : used] = flat
            self.used = used
            found = [self.place[p] for p in pieces]
        return np.array(found, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text)."""
        if self.split_special is None or not any("<" in t and self.split_special.search(t) for t in texts):
            return self._plain(texts)
        parts, marks, sizes = [], [], []
        for text in texts:
            split = self.split_special.split(text)
            parts += ["" if x in self.special else x for x in split]
            marks += [self.special.get(x, -1) for x in split]
            sizes.append(len(split))
        flat, bounds = self._plain(parts)
        marks = np.array(marks)
        own = marks >= 0
        flat = np.insert(flat, bounds[:-1][own], marks[own])
        return flat, tb.bounds_of(np.diff(bounds) + own)[tb.bounds_of(sizes)]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) > self.most:
            self._empty()
        if self.words_only:
            texts = [unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]
        joined = "\0" + "\0".join(texts) + "\0"
        codes = tb.code_points(joined)
        edges = tb.bounds_of([len(t) + 1 for t in texts])  # where each text's END before it stands
        kinds = classes()[codes]
        kinds[edges] = END
        begin = np.flatnonzero(_cuts(codes, kinds, not self.words_only, self.words_only) | (kinds == END))
        end = np.append(begin[1:], len(codes))
        kept = kinds[begin] != END
        if self.words_only:
            kept &= kinds[begin] < BLANK
        begin, end = begin[kept], end[kept]
        at = np.zeros(len(begin), np.int64)
        if len(begin):
            which, keys = pd.factorize(tb.span_hashes(codes, begin, end))
            first = np.empty(len(keys), np.int64)
            first[which[::-1]] = np.arange(len(which))[::-1]
            at = self._places(_spelled(joined, begin[first], end[first]))[which]
            odd = np.flatnonzero(tb.unlike(codes, begin, end, first[which]))
            if len(odd):  # pre-tokens that share a hash with another
                at[odd] = self._places(_spelled(joined, begin[odd], end[odd]))
        lengths = self.length[at]
        flat = tb.gathered(self.ids, self.begin[at], lengths)
        return flat, tb.bounds_of(lengths)[np.searchsorted(begin, edges)]


def _spelled(text: str, begin: np.ndarray, end: np.ndarray) -> list[str]:
    return [text[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]


@lru_cache(1)
def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(4)
def library_vocabulary(path: str) -> Vocabulary:
    """Pre-tokens are encoded by the library's model of the file, which is handed their bytes' characters; one for each worker process and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    chars = dict(enumerate(byte_chars()))
    return Vocabulary(path, lambda pieces: [[x.id for x in model.tokenize(p.encode().decode("latin-1").translate(chars))] for p in pieces])
