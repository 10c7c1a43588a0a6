"""Array kernels over a batch of whole texts: code points, words, hashes, ragged gathers.

A batch is the code points of its texts laid end to end, with the bounds of each
text; everything else is index arithmetic on those arrays.
"""

from __future__ import annotations

import numpy as np

#: Odd 64-bit constants of the hashes here.
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95
_U64 = np.uint64
_place_keys = np.zeros(0, _U64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def _keys(n: int) -> np.ndarray:
    """A key for each place in a span."""
    global _place_keys
    if len(_place_keys) >= n:
        return _place_keys
    keys = mixed(np.arange(1, max(n, 1 << 12) + 1, dtype=_U64) * _U64(_BASE))
    if len(keys) <= 1 << 20:  # longer ones are for one very long span: not kept
        _place_keys = keys
    return keys


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def bounds_of(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(np.asarray(lengths, np.int64), out=out[1:])
    return out


def pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, bounds of each text)."""
    return code_points("".join(texts)), bounds_of([len(t) for t in texts])


def folded(codes: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return codes + (((codes >= 65) & (codes <= 90)).astype(codes.dtype) << 5)


def span_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points, wherever it stands; spans ascend and do not overlap.

    Each code point is mixed with its place in the span before they are summed.
    A sum of powers of one base instead would be equal for some pairs of patterned
    texts (Thue-Morse words and their complements), whatever the base.
    """
    if not len(begin):
        return np.zeros(0, _U64)
    low = int(begin[0])
    lengths = np.diff(begin, append=len(codes))
    place = np.arange(low, len(codes)) - np.repeat(begin, lengths)
    x = codes[low:].astype(_U64)
    x *= _U64(_STEP)
    x += _keys(int(lengths.max()))[place]
    x ^= x >> _U64(29)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(32)
    total = np.zeros(len(x) + 1, _U64)
    np.cumsum(x, out=total[1:])
    return mixed(total[end - low] - total[begin - low] + (end - begin).astype(_U64))


def unlike(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Which spans are not, code point by code point, the same as the span whose number twin gives."""
    size = end - begin
    out = size != size[twin]
    own = np.flatnonzero(~out & (twin != np.arange(len(twin))) & (size > 0))
    if len(own):
        n = size[own]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(begin[own] - first, n)
        other = at + np.repeat(begin[twin[own]] - begin[own], n)
        out[own] = np.logical_or.reduceat(codes[at] != codes[other], first)
    return out


def words(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, bounds of each text's words) of the words [^\\x20\\x09-\\x0D]+."""
    inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    cut = np.zeros(len(codes) + 1, bool)
    cut[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, bounds)


def owner(bounds: np.ndarray) -> np.ndarray:
    """The text of each element."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every window of width elements within a text.

    short: a text with fewer elements, but at least one, gives its whole sequence.
    """
    factors = mixed(np.arange(1, width + 1, dtype=_U64)) | _U64(1)
    of = owner(bounds)
    n = max(0, len(hashes) - width + 1)
    total = np.full(n, width, _U64)
    for j in range(width):
        total += hashes[j : j + n] * factors[j]
    good = of[:n] == of[width - 1 :] if n else np.zeros(0, bool)
    found, texts = [total[good]], [of[:n][good]]
    sizes = np.diff(bounds)
    for size in range(1, width) if short else ():
        which = np.flatnonzero(sizes == size)
        some = np.full(len(which), size, _U64)
        for j in range(size):
            some += hashes[bounds[which] + j] * factors[j]
        found.append(some)
        texts.append(which)
    out, texts = mixed(np.concatenate(found)), np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return out[order], texts[order]


def gathered(blob: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs blob[begin[i] : begin[i] + lengths[i]] one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return blob[np.arange(total) + np.repeat(begin - (ends - lengths), lengths)]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of values in each range of bounds; 0 for an empty range."""
    return np.diff(bounds_of(values)[bounds])
