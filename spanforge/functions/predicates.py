"""Boolean column functions: what a line or a piece of text looks like."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V
from spanforge.functions.text import col, known_title_keys, match_key, rx_class, strip

#: Punctuation, symbols and spaces before the first letter or digit.
LEAD = r"(?U)^[\p{P}\p{S}\s]*"


def has_lowercase(c: Column | str) -> Column:
    return col(c).rlike(r"\p{Ll}")


def is_org_line(c: Column | str) -> Column:
    """Has a letter and no lower-case letter."""
    return col(c).rlike(r"\p{L}") & ~has_lowercase(c)


def has_star(c: Column | str) -> Column:
    return col(c).contains("*")


def is_blank(c: Column | str) -> Column:
    return ~col(c).rlike(r"(?U)\S")


def is_junk_line(c: Column | str) -> Column:
    """Digits, marks and spaces only, 1 to JUNK_LENGTH of them, no cell border."""
    s = strip(c)
    return s.rlike(rf"(?U)^[\d\s{rx_class(V.JUNK_MARKS)}]{{1,{V.JUNK_LENGTH}}}$") & ~s.contains("|")


def is_title_bold(inner: Column | str) -> Column:
    """Whether bold text is a title: a known one, or with a lower-case letter (the ordinal signs count)."""
    return match_key(inner).isin(known_title_keys()) | col(inner).rlike(r"\p{IsLowercase}")


def starts_upper(c: Column | str) -> Column:
    """The first letter or digit after marks is no lower-case letter."""
    return F.regexp_like(col(c), F.lit(LEAD + r"(?:\p{Nd}|[\p{L}&&[^\p{Ll}]])"))


def starts_lower(c: Column | str) -> Column:
    return F.regexp_like(col(c), F.lit(LEAD + r"\p{Ll}"))


def ends_sentence(c: Column | str) -> Column:
    return strip(c).rlike(r"[.!?]$")


def starts_list(c: Column | str) -> Column:
    return col(c).rlike(r"(?U)^\s*(?:[-•—–]|\d+\s*[).])")


def is_table_row(c: Column | str) -> Column:
    s = strip(c)
    pipes = F.length(s) - F.length(F.replace(s, F.lit("|"), F.lit("")))
    return s.startswith("|") & (s.endswith("|") | (pipes >= 3) | s.rlike("[-:]{3,}"))


def is_all_caps(c: Column | str) -> Column:
    """At least two Latin-1 letters, all upper case."""
    letters = F.regexp_replace(col(c), "[^A-Za-zÀ-ÖØ-öø-ÿ]", "")
    return (F.length(letters) >= 2) & (F.upper(letters) == letters)


def bold_only(c: Column | str) -> Column:
    """The inside of a line that is one bold block; empty where it is not."""
    return F.regexp_extract(col(c), r"(?U)^\s*\*\*(.+)\*\*\s*$", 1)


def is_name_gap(c: Column | str) -> Column:
    return col(c).rlike(rf"(?U)^[\s{rx_class(V.GAP_MARKS)}]*$")
