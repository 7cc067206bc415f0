import hashlib
import random
import re

from pyspark.sql import functions as F

from dqloom.llm import exact_dedup

from .helpers import table

RNG = random.Random(1)
LONG = " ".join("".join(RNG.choices("abcdefghijklmnopqrstuvwxyz,.", k=RNG.randrange(2, 9))) for _ in range(60_000))


def brute(texts, ids):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    groups = {}
    for t, i in zip(norm, ids, strict=True):
        groups.setdefault(t, []).append(i)
    return {(i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for t, i in zip(norm, ids, strict=True)}


def test_groups_match_brute_force_with_odd_texts(spark):
    texts = ["a  b", "a b", "a\tb\n", "a b ", None, "", " ", "\n\n", LONG, LONG + " x", LONG.replace(" ", "\n"), "é b", "é b", "日本語" * 9000, "日本語" * 9000]
    ids = list(range(20, 20 + len(texts)))[::-1]
    got = {tuple(r)[:5] for r in exact_dedup.exact_groups(table(spark, texts, ids)).collect()}
    assert got == brute(texts, ids)


def test_chunks_join_to_the_text_and_depend_on_content(spark):
    df = spark.createDataFrame([(LONG,), ("prefix words here " + LONG,), ("x" * 30_000,), ("",)], "t string").withColumn("c", exact_dedup.chunks(F.col("t")))
    rows = df.collect()
    assert all("".join(r.c) == r.t for r in rows)
    assert all(len(c) <= exact_dedup.LONGEST for r in rows for c in r.c)
    shared = set(rows[0].c) & set(rows[1].c)
    assert len(shared) > 0.9 * len(set(rows[0].c))  # a changed start moves no later boundary


def test_repeated_rows_null_keys_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (None, "x"), (1, "y"), (None, None)], "doc_id bigint, text string")
    got = sorted(map(tuple, exact_dedup.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == sorted([(1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False), (1, 1, 1, True), (None, None, 1, True)], key=str)
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    clash = df.withColumns({"sha": F.lit(1), "recipe": F.lit(2), "sha_": F.lit(3), "keep_id": F.lit(4), "kept": F.lit(5)})
    kept = exact_dedup.keep_first(clash)
    assert kept.columns == clash.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == sorted([(1, "x"), (1, "y"), (None, None)], key=str)


def test_main_path_is_native(spark):
    plan = exact_dedup.exact_groups(table(spark, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
