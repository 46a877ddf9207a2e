"""The named queries of the subpackage, each beside the DuckDB SQL that checks it, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.alignment import align
from ebbtide.llm.bitpack import read_ids, write_ids
from ebbtide.llm.decontaminate import decontaminate
from ebbtide.llm.jaccard import jaccard_join
from ebbtide.llm.licenses import license_scan
from ebbtide.llm.oracles import ORACLES  # noqa: F401
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.quality import classify
from ebbtide.llm.runtime import table
from ebbtide.llm.substrings import remove_repeats
from ebbtide.llm.suffix_levels import remove_long_repeats
from ebbtide.llm.token_counts import token_counts
from ebbtide.llm.topk import top_k
from ebbtide.llm.warc import read_archives, write_archives
from ebbtide.llm.whitening import whiten
from ebbtide.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, limit=1024)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs).drop("text", "places")


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(archives, path).drop("url", "payload")


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return classify(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_shingles", "n_copies", "n_links")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_long_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
