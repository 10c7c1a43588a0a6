"""Sources of documents: Markdown folders, JSON contents, PDF pages, settings."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.operators.markdown import merge_bold_runs, rejoin

#: Fixed value: the schema of a table of contents as JSON.
CONTENTS = (
    "items array<struct<paragraph_id: int, org: struct<text: string, label: string>, docs: array<struct<text: string, label: string>>, "
    "top_org: struct<text: string, label: string>, sub_orgs: array<struct<org: struct<text: string, label: string>, docs: array<struct<text: string, label: string>>>>, "
    "org_ids: array<int>, doc_name: struct<text: string, label: string>, children: array<struct<child: string, label: string>>>>, "
    "orgs array<struct<id: int, text: string, label: string>>"
)
PAGE_BREAK = "\n\n---\n\n"


def issues(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each Markdown file: doc_id (its name), path, series, number, issue_date, is_suppl, text."""
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.select(*issue_name("path"), "path", "text")


def issue_name(path: str) -> list:
    """What the name of an issue's file says; null where it says nothing."""
    name = F.regexp_extract(F.col(path), r"([^/]+?)(?:\.[A-Za-z]+)?$", 1)
    parts = r"(?i)^(I{1,3})S[eé]rie-(\d+)-(\d{4}-\d{2}-\d{2})(Supl)?"
    part = lambda i: F.nullif(F.regexp_extract(name, parts, i), F.lit(""))
    return [name.alias("doc_id"), F.upper(part(1)).alias("series"), part(2).try_cast("int").alias("number"), F.try_to_date(part(3)).alias("issue_date"), part(4).isNotNull().alias("is_suppl")]


def is_title_driven(name: str):
    """The flow of an issue: title-driven for the third series, whatever the case of its name."""
    return F.lower(F.col(name)).contains("iiiserie")


def missing(wanted: DataFrame, there: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inputs without an output yet."""
    return wanted.join(there.select(key).distinct(), key, "left_anti")


def contents(spark: SparkSession, path: str) -> DataFrame:
    """Tables of contents from JSON files; fields that are absent are null."""
    return spark.read.schema(CONTENTS).json(path, multiLine=True)


def join_pages(pages: DataFrame, key: str = "doc_id", skip_last: bool = True) -> DataFrame:
    """Pages (key, page_no, md) as one text for each document; the last page is left out on demand, so a document of one page has an empty text."""
    last = F.col("page_no") == F.max("page_no").over(W.partitionBy(key))
    kept = pages.select(key, "page_no", F.when(last & F.lit(skip_last), None).otherwise(F.coalesce("md", F.lit(""))).alias("md"))
    return kept.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("md").isNotNull(), F.struct("page_no", "md"))))["md"], PAGE_BREAK).alias("text"))


def merged_text(docs: DataFrame, key: str = "doc_id", all_caps: bool = False) -> DataFrame:
    """docs (key, text) with neighbouring bold-only lines (those in capitals only, on demand) as one bold block."""
    # A line break at the very end ends a line and begins none.
    rows = docs.select(key, F.posexplode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n", -1)).alias("line_no", "line"))
    return rejoin(merge_bold_runs(rows, key, all_caps), key)


def page_texts(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, page_no, text of each page by itself, neighbouring bold-only lines merged."""
    named = pages.select(F.struct(key, "page_no").alias("_id"), F.coalesce("md", F.lit("")).alias("text"))
    return merged_text(named, "_id").select(f"_id.{key}", "_id.page_no", "text")


def issue_texts(pages: DataFrame, key: str = "doc_id", skip_last: bool = True, title_driven: str = "IIISerie") -> DataFrame:
    """Pages (key, page_no, md) as the text of each issue: joined, bold lines in capitals merged, and all bold lines in issues whose key has title_driven."""
    caps = merged_text(join_pages(pages, key, skip_last), key, all_caps=True)
    driven = F.contains(F.col(key).cast("string"), F.lit(title_driven))
    return caps.where(~driven).unionByName(merged_text(caps.where(driven), key))


def pdf_pages(spark: SparkSession, folder: str, crop_top: float = 0.10) -> DataFrame:
    """Pages of PDF files as Markdown, the top of each page cropped; needs the packages pymupdf and pymupdf4llm on the executors."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import fitz
        import pymupdf4llm

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with fitz.open(stream=content, filetype="pdf") as pdf:
                    for page in pdf:
                        box = page.rect
                        page.set_cropbox(fitz.Rect(box.x0, box.y0 + box.height * crop_top, box.x1, box.y1))
                    marks = [pymupdf4llm.to_markdown(pdf, pages=[i], table_strategy="lines_strict") for i in range(len(pdf))]
                yield pd.DataFrame({"doc_id": path, "page_no": range(len(marks)), "md": marks})

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInPandas(convert, "doc_id string, page_no int, md string")


@dataclass(frozen=True)
class Settings:
    input_dir: Path
    output_dir: Path
    crop_top: float


def _read(path: Path) -> dict:
    try:
        return json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}


@lru_cache(1)
def settings(root: str = ".") -> Settings:
    """Settings by precedence: environment, dev file, base file, defaults; empty and zero values fall through, a malformed number or file too."""
    files = [_read(Path(root) / "config" / name) for name in ("settings.dev.json", "settings.json")]

    def found(env: str, field: str, default):
        options = [os.environ.get(env), *(f.get("pdf_markup", {}).get(field) for f in files)]
        return next((x for x in options if x), default)

    try:
        crop = float(found("PDF_MARKUP_CROP_TOP", "crop_top", 0.10))
    except ValueError:
        crop = 0.10
    return Settings(Path(found("PDF_MARKUP_INPUT_DIR", "input_dir", "input_pdfs")), Path(found("PDF_MARKUP_OUTPUT_DIR", "output_dir", "output_markdown")), crop)
