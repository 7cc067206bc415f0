import random

from pyspark.sql import functions as F

from dqloom.llm import jaccard_join
from dqloom.llm.components import components as spark_components

from .helpers import components, shingles, table


def brute(texts, ids):
    sets = [shingles(t) for t in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links.append((ids[i], ids[j]))
    roots = components(ids, links)
    return {(i, len(s), roots[i]) for i, s in zip(ids, sets, strict=True)}


def made_texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(rng.randrange(40))
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", "  \n ", "one", "One", "one two three four", "one two three four five", "ONE two three\tfour five"]
    base = [[word() for _ in range(rng.randrange(5, 160))] for _ in range(12)]
    for b in base:
        for _ in range(rng.randrange(1, 8)):
            w = list(b)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w[: len(w) - rng.randrange(0, 4)]) + (" " + passage if rng.random() < 0.3 else ""))
    texts += [texts[10], texts[10].upper(), passage, passage + " tail"]
    return texts


def test_components_match_brute_force(spark):
    for seed in (1, 2):
        texts = made_texts(seed)
        ids = random.Random(seed).sample(range(1000), len(texts))
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked_components(table(spark, texts, ids)).collect()}
        assert got == brute(texts, ids)


def test_a_hot_group_of_near_copies_in_chains(spark):
    words = [f"w{i}" for i in range(220)]
    texts = [" ".join(words[i : i + 120]) for i in range(0, 100, 2)]  # each links to its neighbours alone
    ids = list(range(len(texts)))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked_components(table(spark, texts, ids)).collect()}
    assert got == brute(texts, ids) and {r[2] for r in got} == {0}


def test_repeated_rows_null_keys_empty_table_and_clashing_columns(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (None, "q r s t u"), (7, None)], "doc_id bigint, text string").withColumns({"n": F.lit(1), "row": F.lit(2), "key": F.lit(3), "address": F.lit(4), "address_": F.lit(0)})
    got = sorted(map(tuple, jaccard_join.linked_components(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted([(5, 4, 5), (5, 4, 5), (None, 4, 5), (None, 1, None), (7, 0, 7)], key=str)
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == sorted([(5, text), (7, None)], key=lambda x: x[0])
    assert jaccard_join.linked_components(df.limit(0)).count() == 0


def test_wide_signatures_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, m in ((30, 30), (300, 260), (2000, 1700)):
        a = np.unique(rng.integers(0, 1 << 62, n)).astype(np.uint64)
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 62, m).astype(np.uint64)]))
        assert jaccard_join.differing(jaccard_join.wide_signature(a), jaccard_join.wide_signature(b)) <= len(np.setxor1d(a, b))


def test_distributed_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(500, i) for i in range(400, 460)]
    got = {r.node: r.component for r in spark_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {x for e in links if e[0] != e[1] for x in e}
    assert got == components(nodes, links)
    assert spark_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
