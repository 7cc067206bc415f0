"""Joins by similarity, containment and words of names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import top_matches

#: Names that a task holds in memory at once; a larger base is compared in blocks of that size.
BLOCK_NAMES = 100_000
#: Labels that are sent to a task together.
LABELS_PER_TASK = 200


def best_names(labels: DataFrame, names: DataFrame, k: int = 3, cutoff: float = 0.0) -> DataFrame:
    """The k names most like each label by the weighted ratio: label, rank (from 1), name, score.

    labels has distinct texts `label`, names `name` and a distinct `place` that settles ties. Each block of names is
    held once per task (its size is bounded, the base's is not); every label meets every block, spread
    over the tasks, and the blocks' winners are ranked together. Exact: nothing is blocked out.
    """
    spark = labels.sparkSession
    count = names.count()
    blocks = max(1, -(-count // BLOCK_NAMES))
    numbered = names.withColumn("block_", (F.pmod(F.xxhash64("place"), F.lit(blocks))))
    width = spark.sparkContext.defaultParallelism
    found = None
    for block in range(blocks):
        held = numbered.where(F.col("block_") == block).orderBy("place").select("place", "name").collect()
        shared = spark.sparkContext.broadcast(([r.place for r in held], [r.name for r in held]))

        def match(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            places, texts = shared.value
            for frame in frames:
                rows = [(label, places[i], texts[i], s) for label in frame["label"] for i, s in top_matches(label, texts, k, cutoff)]
                yield pd.DataFrame(rows, columns=["label", "place", "name", "score"])

        part = labels.select("label").repartition(max(width, 1)).mapInPandas(match, "label string, place bigint, name string, score double")
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("score"), "place"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("label", "rank", "name", "score")


def nearest_by_edits(labels: DataFrame, names: DataFrame, k: int = 3) -> DataFrame:
    """The k names with the fewest edits, in the JVM: label, rank, name, distance. names has BLOCK_NAMES rows at most; best_names takes more."""
    if names.limit(BLOCK_NAMES + 1).count() > BLOCK_NAMES:
        raise ValueError(f"more than {BLOCK_NAMES} names")
    pairs = labels.select("label").join(F.broadcast(names.select("name", "place")), F.levenshtein("label", "name") <= F.greatest(F.length("label"), F.length("name")))
    scored = pairs.withColumn("distance", F.levenshtein("label", "name"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("distance", "place"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("label", "rank", "name", "distance")


def longest_contained(values: DataFrame, text: Column, words: list[tuple[str, str]]) -> DataFrame:
    """values plus contained: the result of the longest word that text contains, the first one among equals."""
    out = F.lit(None).cast("string")
    for word, result in reversed(sorted(words, key=lambda w: -len(w[0]))):
        out = F.when(F.contains(text, F.lit(word)), F.lit(result)).otherwise(out)
    return values.withColumn("contained", out)


def first_token_hit(values: DataFrame, text: str, tokens: DataFrame) -> DataFrame:
    """Per value, the v of the first of its words that is a k of tokens: text, v."""
    words = values.select(F.col(text), F.posexplode(F.split(F.trim(text), " +")).alias("at", "word"))
    hits = words.join(tokens, words["word"] == tokens["k"])
    return hits.groupBy(text).agg(F.min_by("v", "at").alias("v"))
