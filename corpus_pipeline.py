"""Corpus pipeline: quality rules, language id, near duplicates, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents, and columns beside them, whatever their names.

Defined cases in all stages: an empty table gives an empty result. Rows with null doc_id and rows that repeat a doc_id are
rows like others. What a stage does with null and empty texts, ties and repeated rows is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harrier.llm import jaccard, language, packing, quality, substring
from harrier.llm.common import Scratch
from harrier.llm.queries import table, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the base rules and the trees keep; the trees learn from the labels of this stage's documents.

    Null, empty and short texts fail the base rules and go. Repeated rows are each judged alike. Without labels of both
    kinds the base rules decide."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from every labelled row of this stage's documents.

    Null texts and texts without a letter go, and so do documents the model is unsure of; without a labelled row all go.
    Repeated rows are each judged alike. A null lang is filled in."""
    return language.keep(docs, language.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: of the smallest doc_id, null ids last, then by key of the text.

    Rows repeated whole leave one. Null and empty texts are in no component and stay, one of each id and text."""
    return jaccard.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows.

    Null and empty texts stay as they are; a text that loses all words goes. Repeated rows lose each other's words."""
    return substring.remove(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences.

    A null or empty text is one piece, the end of document. Repeated rows are each packed."""
    return packing.pack(packing.tokenised(docs, tokenizer_path(spark, "word_bpe_49k.json")), packing.bucket_count(docs))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring", substring_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the trained models and the set joins: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents. The tables between them lie in the shared checkpoint folder, each until the next is written."""
    scratch = Scratch(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
        scratch.empty(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
