from __future__ import annotations

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanforge.functions import predicates as P
from spanforge.functions import text as T
from spanforge.functions import vocabulary as V


def values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_keys(spark):
    texts = ["**N.º 5** Direção", "São João — ß", "", "A B"]
    assert values(spark, T.match_key("s"), texts) == ["**n.o5**direcao", "saojoao—ss", "", "ab"]
    assert values(spark, T.letters_key("s"), texts) == ["nodirecao", "saojoaoss", "", "ab"]
    assert values(spark, T.org_key("s"), texts) == ["N5DIRECAO", "SAOJOAO", "", "AB"]
    assert values(spark, T.letters_key("s"), [None]) == [""]


def test_accents_cover_latin_1(spark):
    chars = [chr(c) for c in range(0xC0, 0x100) if unicodedata.decomposition(chr(c))]
    want = ["".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x)) for c in chars]
    assert values(spark, T.strip_accents("s"), chars) == want


def test_plain_text(spark):
    assert values(spark, T.plain_text("s"), ["**D IREÇÃO  R EGIONAL**", "um DOIS tres", None]) == ["DIREÇÃOREGIONAL", "um DOIS tres", ""]
    assert values(spark, T.join_spaced_caps("s"), ["D IREÇÃO R EGIONAL", "a B C d"]) == ["DIREÇÃOREGIONAL", "a BC d"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="AÇ b1", max_size=12), min_size=1, max_size=20))
def test_one_pass_joins_all_spaced_caps(spark, texts):
    texts = [" ".join(t.split()) for t in texts]

    def fixpoint(s):
        while True:
            new = re.sub(rf"([ {V.SPACED_CAPS}])\s(?=[{V.SPACED_CAPS}])", r"\1", s)
            if new == s:
                return s
            s = new

    assert values(spark, T.join_spaced_caps("s"), texts) == [fixpoint(t) for t in texts]


def test_title_norm_and_tokens(spark):
    assert values(spark, T.title_norm("s"), [" **A  b:** ", "x::", "**"]) == ["A b", "x:", "**"]
    assert [sorted(v) for v in values(spark, T.tokens("s"), ["The the  b", ""])] == [["b", "the"], []]


def test_ngrams_and_jaccard(spark):
    assert [sorted(v) for v in values(spark, T.ngrams("s"), ["abcab", "ab", ""])] == [["abc", "bca", "cab"], ["ab"], []]
    row = spark.range(1).select(T.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("x"), T.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("y")).first()
    assert row.x == pytest.approx(1 / 3) and row.y == 0


def test_junk_lines(spark):
    assert values(spark, P.is_junk_line("s"), ["12 - 3", "-" * 20, "-" * 21, "| - |", "a", "", "  ", "1º"]) == [True, True, False, False, False, False, False, False]


def test_title_bold(spark):
    assert values(spark, P.is_title_bold("s"), ["N.º", "DESPACHOS:", "D e s p a c h o s :", "ABC"]) == [True, True, True, False]
    assert values(spark, P.is_org_line("s"), ["**N.º**", "ABC d", "12"]) == [True, False, False]


def test_starts_and_ends(spark):
    assert values(spark, P.starts_upper("s"), ["«A", "1 a", "«a", "", "漢"]) == [True, True, False, False, True]
    assert values(spark, P.starts_lower("s"), ["(a", "A", "1a"]) == [True, False, False]
    assert values(spark, P.ends_sentence("s"), ["a. ", "a", "a?"]) == [True, False, True]


def test_table_rows_and_caps(spark):
    assert values(spark, P.is_table_row("s"), ["|a|", "|a", "|a|b|c", "|---", "a|b|", ""]) == [True, False, True, True, False, False]
    assert values(spark, P.is_all_caps("s"), ["AB 1", "A", "Ab", "ÀÉ"]) == [True, False, False, True]


def test_escape_and_slug(spark):
    assert values(spark, T.html_escape("s"), ["<a href=\"x\">&'"]) == ["&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"]
    assert values(spark, T.slug("s"), ["a b/ç"]) == ["a_b_ç"]


def test_strip_takes_what_the_pattern_takes(spark):
    """Every character of the basic plane (surrogates aside), at both ends; and no search through the text."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(f"{chr(i)} a {chr(i)}b{chr(i)}\n",) for i in range(0x10000) if not 0xD800 <= i < 0xE000], "c string")
    old = F.regexp_replace("c", r"(?U)^\s+|\s+$", "")
    assert rows.where(T.strip("c") != old).count() == 0
    assert rows.where(T.collapse_spaces("c") != F.regexp_replace(F.regexp_replace("c", r"(?U)\s+", " "), r"(?U)^\s+|\s+$", "")).count() == 0
    assert "regexp" not in T.strip("c")._jc.toString()
