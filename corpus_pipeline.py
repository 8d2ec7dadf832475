"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its
result is written as Parquet and read again. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontam, langid, linededup, packing, simhash
from tidemill.llm.common import own_names, read, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no known language: null, empty, without letters, or of unsure words.

    Words are judged by their own language each, so that a text in n languages evenly stays.
    """
    return langid.keep_known(docs, langid.fit(langid.sample(docs)), mixed=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes common lines out of all documents but one; ``n_chars`` follows the text."""
    kept, (text,) = linededup.dedup_lines(docs), own_names(docs, "__kept")
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return kept.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every piece with its sequence and its place there."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: The language model cannot be said in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
