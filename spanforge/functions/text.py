"""Column functions over strings: comparison keys, sets of tokens and n-grams, escaping.

All are built-in expressions, so they stay in generated code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rx_class(chars: str) -> str:
    """Characters as the inside of a regular expression class."""
    return "".join("\\" + c if c in "\\[]^-{}()|&~" else c for c in chars)


def strip(c: Column | str) -> Column:
    """Without white space at both ends, found from the ends, not by a search through the text."""
    return F.btrim(col(c), F.lit(V.WHITE))


def strip_accents(c: Column | str) -> Column:
    """Canonical decomposition without marks: the ordinal signs stay."""
    return F.translate(col(c), V.ACCENTED, V.BASE)


def strip_accents_compat(c: Column | str) -> Column:
    """Compatibility decomposition without marks: the ordinal signs become letters."""
    return F.translate(col(c), V.ACCENTED + V.ORDINALS, V.BASE + V.ORDINAL_BASE)


def casefold(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(col(c)), "ß", "ss")


def match_key(c: Column | str) -> Column:
    """Without accents and any white space, casefolded."""
    return casefold(F.regexp_replace(strip_accents_compat(c), f"[{V.WHITE}]+", ""))


def letters_key(c: Column | str) -> Column:
    """Letters only, without accents, casefolded; null is empty."""
    return casefold(F.regexp_replace(strip_accents_compat(F.coalesce(col(c), F.lit(""))), r"[^\p{L}]+", ""))


def strip_bold(c: Column | str) -> Column:
    return strip(F.replace(col(c), F.lit("**"), F.lit("")))


def collapse_spaces(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), f"[{V.WHITE}]+", " "))


def join_spaced_caps(c: Column | str) -> Column:
    """Drops the gap after a capital (or a space) and before a capital; one pass does, as gaps are single."""
    return F.regexp_replace(col(c), rf"(?U)(?<=[ {V.SPACED_CAPS}])\s(?=[{V.SPACED_CAPS}])", "")


def plain_text(c: Column | str) -> Column:
    """Bold marks, runs of spaces and letter spacing taken away; null is empty."""
    return join_spaced_caps(collapse_spaces(strip_bold(F.coalesce(col(c), F.lit("")))))


def org_key(c: Column | str) -> Column:
    """ASCII letters and digits of an organisation's name, upper case, without accents."""
    bare = F.regexp_replace(strip_accents(F.replace(F.coalesce(col(c), F.lit("")), F.lit("**"), F.lit(""))), "[^A-Za-z0-9]+", "")
    return F.upper(bare)


def ascii_letters(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(strip_accents(col(c))), "[^a-z0-9]+", "")


def title_norm(c: Column | str) -> Column:
    """Outer bold unwrapped, spaces collapsed, one final colon dropped."""
    inner = F.regexp_replace(strip(c), r"(?s)^\*\*(.*)\*\*$", "$1")
    return strip(F.regexp_replace(collapse_spaces(inner), r":$", ""))


def unwrapped(c: Column | str) -> Column:
    """Spaces collapsed, then outer bold unwrapped; null is empty."""
    return strip(F.regexp_replace(collapse_spaces(F.coalesce(col(c), F.lit(""))), r"(?s)^\*\*(.*)\*\*$", "$1"))


def tighten(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


def tokens(c: Column | str) -> Column:
    """The set of lower-case words."""
    words = F.split(F.lower(strip(c)), r"(?U)\s+")
    return F.array_remove(F.array_distinct(words), "")


def ngrams(c: Column | str, n: int = V.GRAM) -> Column:
    """The set of character n-grams; a shorter string is its own; none of an empty one."""
    s = col(c)
    grams = F.array_distinct(F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).when(F.length(s) < n, F.array(s)).otherwise(grams)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Of two sets; 0 where both are empty."""
    inter, union = F.size(F.array_intersect(col(a), col(b))), F.size(F.array_union(col(a), col(b)))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def between(text: Column | str, head_end: Column | str, tail_start: Column | str) -> Column:
    """The text between two spans, trimmed: what a relation rests on."""
    return strip(F.substring(col(text), (col(head_end) + 1).cast("int"), (col(tail_start) - col(head_end)).cast("int")))


def slug(c: Column | str, most: int = 120) -> Column:
    return F.substring(F.regexp_replace(col(c), r"(?U)[^\w.-]+", "_"), 1, most)


def html_escape(c: Column | str) -> Column:
    out = col(c)
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def known_title_keys() -> list[str]:
    """KNOWN_TITLES as match_key() gives them."""
    table = str.maketrans(V.ACCENTED + V.ORDINALS, V.BASE + V.ORDINAL_BASE)
    return [re.sub(r"\s+", "", t.translate(table)).lower() for t in V.KNOWN_TITLES]
