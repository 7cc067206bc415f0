import random

import numpy as np
from pyspark.sql import functions as F

from dqloom.llm import language_id, quality

from .helpers import DOCS, held_out

SYLLABLES = {"aa": ["ka", "lo", "mi", "zu", "ta"], "bb": ["sch", "ung", "ein", "ver", "te"], "cc": ["ção", "ém", "ão", "os", "da"]}
JUNK = ["!!", "###", "BUY", "NOW", "$$$"]


def prose(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, prose(rng, lang), lang, f"s{i % 4}", 100))
    return rows, spark.createDataFrame(rows, DOCS)


def test_language_held_out_accuracy_and_folds(spark):
    rows, df = corpus(spark)
    got = language_id.predicted(df).collect()
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in got if r.held_out]
    assert len(out) > 40 and np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_held_out_documents_alone_are_never_learned(spark):
    rows, _ = corpus(spark)
    rows = [(i, t, "only-held-out" if held_out(i) else lang, s, n) for i, t, lang, s, n in rows]
    got = language_id.predicted(spark.createDataFrame(rows, DOCS)).select("lang_pred").distinct().collect()
    assert {r.lang_pred for r in got} <= set(SYLLABLES)


def test_language_edges(spark):
    rng = random.Random(2)
    rows, df = corpus(spark)
    long = prose(rng, "aa", 20) + " " + prose(rng, "bb", 30_000)
    extra = spark.createDataFrame([(1000, None, None, None, None), (1001, "", "aa", "s", 0), (1002, "12 34 !!", "aa", "s", 8), (1003, long, None, "s", 9), (1004, "é", "bb", "s", 1), (1004, "é", "bb", "s", 1), (None, "kalo", "aa", "s", 4)], DOCS)
    all_ = df.unionByName(extra).withColumns({"score": F.lit("clash"), "letters_": F.lit(1)})
    got = {r.doc_id: r for r in language_id.predicted(all_).collect() if r.doc_id is None or r.doc_id >= 1000}
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "bb" and not got[None].held_out
    kept = language_id.keep_identified(all_)
    assert kept.columns == all_.columns and kept.count() == all_.count() - 3 and {r.score for r in kept.select("score").distinct().collect()} == {"clash"}
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.predicted(unlabelled).where("lang_pred <> 'und'").count() == 0
    assert language_id.predicted(df.limit(0)).count() == 0


def test_windows_hold_every_byte():
    data = np.arange(700, dtype=np.int64).astype(np.uint8)
    windows, row, filled = language_id.windows_of(data, np.array([0, 0, 300, 556, 700]))
    assert row.tolist() == [1, 1, 2, 3] and filled.tolist() == [256, 44, 256, 144]
    assert np.concatenate([w[:n] for w, n in zip(windows, filled, strict=True)]).tolist() == data.tolist()


def quality_corpus(spark, n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = rng.random() < 0.3, rng.random() < 0.2
        words = prose(rng, "aa", 50).split()
        if bad:
            words = [w.upper() + rng.choice(JUNK) for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "nastyword"]))
        rows.append((i, " ".join(words), "en", "spamhost" if bad and rng.random() < 0.9 else f"s{i % 3}", 100))
        labels.append((i, 0 if bad else 1, int(toxic)))
    return rows, labels


def test_cotraining_scores_documents_it_hasnt_seen(spark):
    rows, labels = quality_corpus(spark)
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels[:240], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(docs, known).collect()}
    unseen = labels[240:]
    assert np.mean([(got[i].quality_score >= 0.5) == (q == 1) for i, q, _ in unseen]) > 0.95
    assert np.mean([(got[i].toxic_score >= 0.5) == (t == 1) for i, _, t in unseen]) > 0.9
    assert np.mean([got[i].keep for i, q, t in unseen if q == 1 and t == 0]) > 0.95


def test_the_views_teach_each_other():
    rng = np.random.default_rng(4)
    n = 600
    y = (rng.random(n) < 0.5).astype(int)
    index = [np.array([y[i] * 3 + rng.integers(3)]) for i in range(n)]
    view = (np.arange(n + 1), np.concatenate(index), np.zeros((n, 0)))
    labels = y.copy()
    labels[100:] = -1
    model = quality.cotrain(view, view, labels, np.arange(n) % 5 == 0)
    assert sum(a + b for a, b in model.added) > 0
    assert ((model.score(view, view) > 0.5) == y).mean() == 1.0


def test_quality_edges(spark):
    rows, labels = quality_corpus(spark, 120)
    extra = [(500, None, None, None, None), (501, "", "en", "s", 0), (502, "word " * 40_000, "en", "s", 5), (None, "x y z", None, None, 1), (1, rows[1][1], "en", "s1", 100)]
    docs = spark.createDataFrame(rows + extra, DOCS).withColumns({"keep": F.lit("clash"), "quality_score": F.lit(5), "y0": F.lit(1)})
    known = spark.createDataFrame([*labels, (None, 1, 0), (7, None, None), (8, 1, None), (0, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.judged(docs, known).collect()
    assert len(got) == len(rows) + len(extra) and all(r.quality_score is not None for r in got)
    none = quality.judged(docs, known.limit(0)).collect()
    assert all(r.quality_score is None and r.keep for r in none)
    assert quality.judged(docs.limit(0), known).count() == 0


def test_the_network_matches_a_plain_convolution():
    import numpy as np

    from dqloom.llm.language_id import WIDTHS, WINDOW, train, windows_of

    net = train(["ab cd " * 30, "xyz wvu " * 30, "ab ab cd " * 20, "wvu xyz " * 20] * 4, ["a", "b", "a", "b"] * 4)
    data = np.frombuffer(("ab xyz é cd" * 40).encode(), np.uint8)
    windows, _, filled = windows_of(data, np.array([0, len(data)]))
    want = []
    for w in windows:
        features = []
        for width, table in zip(WIDTHS, net.tables, strict=True):
            responses = [sum(table[j][w[i + j]] for j in range(width)) for i in range(WINDOW - width + 1)]
            features += list(np.max(responses, axis=0))
        want.append(np.maximum(np.array(features) + net.bias, 0) @ net.weights + net.offset)
    assert filled.sum() == len(data) and np.allclose(net.logits(windows), np.array(want), atol=1e-4)
