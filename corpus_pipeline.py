"""From raw documents to packed sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet and read again as the docs of the next.  All but the last return the
columns of their input, with the rows that stay.  Each stage works on all rows
that the stage before it kept, and gathers what it needs from them.

Defined cases: a null or empty text goes in the first stage (no letters), as does
one without a word in the second; a null doc_id or source is a value like others
and no near copy of anything; rows that repeat a doc_id become one in the third
stage; a very long text is handled whole in every stage; ties follow the
operators (smallest doc_id of a group, first label in order); extra columns are
carried through the filtering stages whatever their names; an empty table passes
through all stages as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanforge.llm import common, language_id, near_dedup, packing, quality

#: Languages to keep, as labels of the column lang; None for all that are labelled there.
LANGUAGES: list[str] | None = None


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, in languages that are not expected, or under the model's floor."""
    return language_id.accepted(docs, language_id.fitted(docs), LANGUAGES)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that break the quality rules, as their host allows."""
    return quality.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dedup.deduplicated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", tell_language),
    ("quality", judge_quality),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: A trained network, hashed signatures and a tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.written(docs, f"pipeline-{name}")
    return docs
