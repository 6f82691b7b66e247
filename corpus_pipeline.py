"""A corpus pipeline of five stages over `documents`: languages, near copies, repeated passages, test items, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the
columns of documents."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwork.llm import bpe, contamination, language, neardup, repeats  # noqa: E402
from tillwork.llm.common import settle, table, with_row_key  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: those without a letter and those too far from every centroid."""
    docs = docs.select(*COLUMNS)
    return language.annotate(docs, language.fit(docs), "text").where("not rejected").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of equal and similar texts."""
    rows = with_row_key(docs.select(*COLUMNS))
    kept = neardup.near_duplicates(rows, row_key="rid").where("kept").select("rid")
    return rows.join(kept, "rid", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of strings of 400 bytes and of passages of 50 words, which may have fewer bytes; a document
    of which no word is left goes."""
    docs = docs.select(*COLUMNS)
    cleaned = repeats.remove_repeats(
        docs, keep_first=True, characters=True, keep=["lang", "source", "n_chars"], words=repeats.WORDS
    )
    text = F.when(F.col("n_bytes") > 0, F.col("kept").cast("string"))
    changed = F.size("spans") > 0
    return cleaned.where(~changed | F.col("kept").cast("string").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(changed, F.length(F.col("kept").cast("string")).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    held = contamination.with_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return held.where(F.size("leaks") == 0).select(*COLUMNS)


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, as little-endian 32-bit integers, and what they decode to."""
    coded = bpe.encode_documents(docs)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe_ids", bpe_ids),
]

# Centroids, samples, suffix order and token ids are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
