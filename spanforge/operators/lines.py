"""Documents as lines with exact character offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.text import strip


#: Values that are folded together.
CHUNK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often and wherever use has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def before(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each of values the fold of zero and all values before it, in the order of the array.

    Folds are taken in chunks and over chunks, so that work is not quadratic in a
    long array.
    """

    def folds(some: Column, first: Column) -> Column:
        return F.slice(F.aggregate(some, F.array(first), lambda all_, x: F.array_append(all_, add(F.element_at(all_, -1), x))), 1, F.size(some))

    total = lambda chunk: F.aggregate(chunk, zero, add)
    chunked = lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), lambda c: F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)))
    folded = lambda chunks: F.flatten(F.zip_with(chunks, folds(F.transform(chunks, total), zero), folds))
    return bound(values, lambda all_: bound(chunked(all_), folded))


def starts_of(lengths: Column) -> Column:
    """The sum of the lengths before each."""
    return before(lengths, F.lit(0).cast("bigint"), lambda s, n: s + n)


def line_array(text: Column) -> Column:
    """The lines of a text in order: line and start, in code points; the line break is outside."""
    return bound(F.split(text, "\n", -1), lambda all_: F.arrays_zip(all_.alias("line"), starts_of(F.transform(all_, lambda x: F.length(x).cast("bigint") + 1)).alias("start")))


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, line, start, end (half-open, in code points; the line break is outside).

    Offsets are summed up within the row, so no text is shuffled.  Rows that
    repeat a key are lines of texts of their own, each with offsets from 0.
    """
    split = docs.where(F.col(text).isNotNull()).select(F.col(key), F.split(F.col(text), "\n", -1).alias("_lines"))
    starts = starts_of(F.transform("_lines", lambda x: F.length(x).cast("bigint") + 1))
    out = split.select(key, F.posexplode_outer(F.arrays_zip(F.col("_lines").alias("line"), starts.alias("start"))).alias("line_no", "_l"))
    return out.select(key, "line_no", F.col("_l.line").alias("line"), F.col("_l.start").alias("start"), (F.col("_l.start") + F.length("_l.line")).alias("end"))


def visible(rows: DataFrame) -> DataFrame:
    """Lines that are not blank, with their range without outer white space."""
    lead = F.length("line") - F.length(F.regexp_replace("line", r"(?U)^\s+", ""))
    return rows.where(F.col("line").rlike(r"(?U)\S")).withColumn("start", F.col("start") + lead).withColumn("line", strip("line")).withColumn("end", F.col("start") + F.length("line"))
