"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing by source, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm.common import read, stored
from tallybrook.llm.mixing import mix
from tallybrook.llm.near_dups import one_per_group
from tallybrook.llm.packing import pack_documents
from tallybrook.llm.quality import keep_good
from tallybrook.llm.toxicity import keep_civil


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or whose votes make bad quality likelier.

    Null and empty texts fail; repeated rows stay or go alike; other columns and their nulls pass as they are. No
    documents give none.
    """
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents scored as toxic; the labels teach the classifier.

    Texts without words stay; labels that are null or of no document do nothing, and without any all documents
    stay; repeated rows stay or go alike.
    """
    return keep_civil(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares 80 % of its five-word shingles.

    That is the one with the smallest id, null last, and one of repeated rows; texts without words all stay.
    """
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out the documents of each source to its target.

    A null source is a source; a text without words has size 0 and is taken at its source's rate like others.
    """
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into windows of 4096; one row per piece, ids included.

    A null or empty text is the end token alone, a null id stays null, repeated rows are documents of their own; no
    documents give no pieces.
    """
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models and tokenizers cannot be expressed in SQL; tests/llm holds the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what its predecessor wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
