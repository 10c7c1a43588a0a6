"""Clean-up of Markdown text: tables told apart, bold runs merged, inline bold consolidated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.functions import predicates as P
from spanforge.functions.text import col, collapse_spaces, strip


def merge_bold_runs(rows: DataFrame, key: str = "doc_id", all_caps: bool = False) -> DataFrame:
    """Lines (key, line_no, line) with runs of bold-only lines as one bold block; a table row or any other line ends a run.

    all_caps: only lines whose bold text is upper case are merged.
    """
    inner = P.bold_only("line")
    bold = (inner != "") & ~P.is_table_row("line")
    if all_caps:
        bold = bold & P.is_all_caps(inner)
    w = W.partitionBy(key).orderBy("line_no")
    marked = rows.select(key, "line_no", "line", bold.alias("bold"), inner.alias("inner"))
    runs = marked.withColumn("run", F.sum(F.when(F.col("bold") & F.coalesce(F.lag("bold").over(w), F.lit(False)), 0).otherwise(1)).over(w))
    parts = F.array_sort(F.collect_list(F.struct("line_no", F.when(F.col("bold"), F.col("inner")).otherwise(F.col("line")).alias("part"))))
    grouped = runs.groupBy(key, "run").agg(F.min("line_no").alias("line_no"), F.first("bold").alias("bold"), F.array_join(parts["part"], "\n").alias("text"), F.count(F.lit(1)).alias("n_lines"))
    text = F.when(F.col("bold"), F.concat(F.lit("**"), F.col("text"), F.lit("**"))).otherwise(F.col("text"))
    return grouped.select(key, "line_no", text.alias("text"), "n_lines")


def rejoin(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines in order as one text."""
    parts = F.array_sort(F.collect_list(F.struct("line_no", text)))
    return rows.groupBy(key).agg(F.array_join(parts[text], "\n").alias(text))


def unglue_bold(c: Column | str) -> Column:
    """A space between a bold mark and a letter or digit glued to it."""
    glued = "[A-Za-zÀ-ÖØ-öø-ÿ0-9]"
    return F.regexp_replace(F.regexp_replace(col(c), rf"({glued})\*\*", "$1 **"), rf"\*\*({glued})", "** $1")


def one_bold_block(c: Column | str) -> Column:
    """A line with bold marks, no table row, as one bold block; a line that is one already, or has nothing else, stays."""
    line, bare = col(c), strip(col(c))
    marks = (F.length(line) - F.length(F.replace(line, F.lit("**"), F.lit("")))) / 2
    single = bare.startswith("**") & bare.endswith("**") & (marks == 2)
    content = collapse_spaces(F.replace(unglue_bold(line), F.lit("**"), F.lit("")))
    stays = (marks < 1) | P.is_table_row(line) | single | (content == "")
    return F.when(stays, line).otherwise(F.concat(F.lit("**"), content, F.lit("**")))
