"""Fill-in-middle by escaped marker injection, in SQL functions only.

The text is cut into units by a pattern.  A delimiter that no text keeps is put
behind every unit by one regexp_replace, so the number of units is the number of
delimiters, and any run of units is two calls of substring_index by rank:

1. escape: the delimiter and the escape character become two characters each,
   the pattern takes such a pair as one unit;
2. inject: regexp_replace appends the delimiter to every unit;
3. count the delimiters and draw the two cuts from the document's hash;
4. extract: units before the first cut, between the cuts, after the second;
5. drop the delimiters, unescape, assemble with the sentinels.

Everything is a projection of one row: no shuffle, no Python, nothing that
depends on other documents, so hot keys do not matter.

Defined cases: a null text is empty, and an empty one plain with n = 0; texts
that hold a sentinel stay plain, so that what is put together can always be
taken apart; texts that hold the delimiter or the escape character are escaped
like any other; the two cuts may be equal (an empty middle) or at the ends; a
very long text is one row and handled whole; a null doc_id is hashed as an
empty number; repeated rows give equal rows; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common

#: Units of a text, left to right, over code points.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of documents that stay plain, and of the others that are in suffix-prefix-middle order.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: The delimiter, the escape character, and what follows it for each of the two; no letters, so that no unit grows.
DELIMITER, ESCAPE, OF_DELIMITER, OF_ESCAPE = "\u0001", "\u0002", "3", "4"


def escaped(text: Column) -> Column:
    """text without the delimiter; as long in units under marked()."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + OF_ESCAPE)), F.lit(DELIMITER), F.lit(ESCAPE + OF_DELIMITER))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + OF_DELIMITER), F.lit(DELIMITER)), F.lit(ESCAPE + OF_ESCAPE), F.lit(ESCAPE))


def marked(text: Column, unit: str = UNIT) -> Column:
    """text, escaped, with the delimiter behind every unit."""
    return F.regexp_replace(escaped(text), f"{ESCAPE}[{OF_DELIMITER}{OF_ESCAPE}]|{unit}", f"$0{DELIMITER}")


def n_units(marks: Column) -> Column:
    return (F.length(marks) - F.length(F.replace(marks, F.lit(DELIMITER), F.lit("")))).cast("long")


def units(marks: Column, begin: Column, end: Column) -> Column:
    """The text of the units from begin to before end, of marked text."""
    head = F.call_function("substring_index", marks, F.lit(DELIMITER), end.cast("int"))
    part = F.call_function("substring_index", head, F.lit(DELIMITER), (begin - end).cast("int"))
    return unescaped(F.replace(part, F.lit(DELIMITER), F.lit("")))


def units_from(marks: Column, begin: Column, n: Column) -> Column:
    """The text of the units from begin to the last of n: marked text ends in a delimiter, so counting from its end needs one more."""
    tail = F.call_function("substring_index", marks, F.lit(DELIMITER), (begin - n - 1).cast("int"))
    return unescaped(F.replace(tail, F.lit(DELIMITER), F.lit("")))


def draws(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first groups of eight hexadecimal digits of a hash of its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    No part holds a sentinel and none can arise where a part meets one (each
    begins with < and ends with >), so the sentinels of an output are those that
    were put there.
    """
    def cut(text: Column, mark: str, n: int) -> Column:
        return F.call_function("substring_index", text, F.lit(mark), F.lit(n))

    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    head, middle = cut(body, MIDDLE, 1), cut(body, MIDDLE, -1)
    psm = F.concat(cut(head, SUFFIX, 1), middle, cut(head, SUFFIX, -1))
    spm = F.concat(cut(head, PREFIX, -1), middle, cut(head, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def transformed(docs: DataFrame, seed: str = "1", unit: str = UNIT) -> DataFrame:
    """docs (doc_id, text) as doc_id, n, form, prefix, middle, suffix (null if plain) and output.

    Each step is a projection of its own, so that what later steps use more than
    once is computed once.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    rows = rows.withColumn("marks", marked(F.col("text"), unit)).withColumn("n", n_units(F.col("marks")))
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.withColumn("low", F.least(first, second)).withColumn("high", F.greatest(first, second))
    held = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | held | (F.col("h3") % 100 >= 100 - PLAIN_PERCENT)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < SPM_PERCENT, "spm").otherwise("psm"))
    some, marks = F.col("form") != "plain", F.col("marks")
    parts = rows.select(
        "doc_id",
        "n",
        "form",
        "text",
        F.when(some, units(marks, F.lit(0), F.col("low"))).alias("prefix"),
        F.when(some, units(marks, F.col("low"), F.col("high"))).alias("middle"),
        F.when(some, units_from(marks, F.col("high"), F.col("n"))).alias("suffix"),
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return parts.withColumn("output", output).drop("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output and of the text rebuilt from it."""
    out = transformed(common.table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


_DRAW = "('0x' || digest[{0}:{1}])::BIGINT AS h{2}"
ORACLE_SQL = f"""WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
cut AS (SELECT doc_id, text, regexp_extract_all(text, '{UNIT}') AS u, {", ".join(_DRAW.format(8 * i + 1, 8 * i + 8, i + 1) for i in range(4))} FROM hashed),
sized AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain' WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM sized)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""
