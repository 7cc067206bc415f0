"""From raw documents to packed training sequences, in five stages.

Each stage works on what the one before has kept, as a written table. Language ID drops documents without a
language, exact dedup and the n-gram Jaccard join drop copies and near copies but for the first of each group, decontamination drops
documents that share a window with the benchmark, and packing cuts the rest into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqloom.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from dqloom.llm.common import read_table, written
from dqloom.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A network trained here decides the first stage, so SQL can't express the rows.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL}
