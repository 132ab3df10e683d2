"""The corpus pipeline: quality rules, line dedup, near-duplicate join, personal data, packing.

Every stage takes documents with null values, repeated rows, empty or very long texts, no rows at all, and further columns
of any name, which it passes on; what it makes of each case stands at the stage. Only doc_id, text, source and n_chars are
read. Stages but the last give the columns they get.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import common, jaccard_join, lines, packing, pii, quality


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars (where there) counted anew."""
    return docs.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition and base rules keep, unchanged. Null and empty texts have no words and go; equal rows
    are judged alike, so both stay or go; a share of just the limit stays."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source, n_chars anew. Null texts stay null, with a null n_chars;
    null sources are one source; equal rows count each as a page; a line on just the ratio of pages stays."""
    return _recounted(lines.drop_boilerplate(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; of rows that repeat its id and text, one.
    Null ids link with nothing and stay, as do null texts and texts without words; a similarity of just 0.8 links."""
    return jaccard_join.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, n_chars anew; null texts stay null. Equal rows are searched each."""
    return _recounted(pii.redact(docs, pii.train(docs)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences, one row each, with their ids. A null text is empty and gives the end id alone; equal rows are
    packed each, null ids stay null."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", pack)]

#: Shingles, tokens and the random field are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
