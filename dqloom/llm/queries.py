"""The registered queries op1 to op10 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, jaccard_join, language_id, licenses, packing, paragraph_dedup, quality, token_count, url_filter
from .common import read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(read_table(spark, sf_dir, "documents"))


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_passages(read_table(spark, sf_dir, "documents")).drop("spans", "address")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents")).drop("n_chunks", "n_rows")


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_url_filter, op3_license_scan, op4_quality, op5_packing, op6_token_counts, op7_jaccard_join, op8_language_id, op9_paragraph_dedup, op10_exact_dedup)}

SQL = {
    "op1_decontamination": decontaminate.judged_sql(),
    "op3_license_scan": licenses.scan_sql(),
    "op7_jaccard_join": jaccard_join.components_sql(),
    "op10_exact_dedup": r"""
WITH d AS (SELECT DISTINCT ON (doc_id, t) doc_id, t, count(*) OVER (PARTITION BY t) AS group_size, min(doc_id) OVER (PARTITION BY t) AS keep_id
  FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM d""",
}
