"""The corpus pipeline: from documents to packed training sequences.

Each stage takes what the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.decontaminate import decontaminate
from ebbtide.llm.jaccard import jaccard_join, keep_one
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.quality import classify
from ebbtide.llm.runtime import stored, table
from ebbtide.llm.substrings import remove_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither poor nor toxic."""
    judged = classify(docs, table(spark, sf_dir, "labels"))
    return judged.where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group tied together by five-word shingles."""
    return keep_one(docs, jaccard_join(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; a text that loses none stays as it is."""
    names = docs.columns
    cut = F.col("n_removed") > 0
    out = remove_repeats(docs).withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*names)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of a benchmark than the limit."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]
#: SQL has no tokenizer and no fitted model; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
