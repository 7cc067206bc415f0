import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from dqloom.llm import quality

from .helpers import DOCS


def test_words_count_whatever_is_attached_and_all_documents_are_learned_from(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(5000):
        toxic = rng.random() < 0.2
        words = ["".join(rng.choices("abcdefgh", k=3)) for _ in range(12)]
        if toxic:
            words.insert(rng.randrange(12), rng.choice(["vileword", "nastyword"]) + ("" if i < 300 else rng.choice([",", "###", ";", ":", "*"]) * rng.randrange(1, 9)))
        rows.append((i, " ".join(words), "en", "s", 50))
        labels.append((i, rng.randrange(2), int(toxic)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels[:300], "doc_id bigint, quality int, toxic int")
    frame, others = quality._sample(docs, known, ["quality", "toxic"], [], "text", "doc_id")
    assert len(frame) == 300 and others.count() == 4700
    got = {r.doc_id: r for r in quality.judged(docs, known).collect()}
    toxic = [got[i] for i, _, t in labels[300:] if t]
    assert np.mean([r.toxic_score >= 0.5 for r in toxic]) > 0.9 and not any(r.keep for r in toxic if r.toxic_score >= 0.5)


def test_copies_in_many_tasks_dont_crowd_out_the_surest_texts(spark):
    texts = {n: " ".join(f"w{i}" for i in range(n)) for n in (1, 3, 7, 15, 31, 63, 127)}
    rows = [(t,) for n, t in texts.items() for _ in range(40 if n in (1, 127) else 1)]
    others = spark.createDataFrame(rows, "text string").repartition(8)
    dense = np.zeros(quality.STATS)
    dense[2] = 30  # 6 times the logarithm of the words
    text = quality.Linear(np.zeros(quality.BUCKETS), dense, np.zeros(quality.STATS), np.ones(quality.STATS), -15.0)
    meta = quality.Linear(np.zeros(quality.META_BUCKETS), np.zeros(0), np.zeros(0), np.zeros(0))
    same = np.array([1.0, 0.0])
    by_text, by_meta = quality._surest(others, {"quality": (0, [text, meta], [same, same])}, [], 4)["quality"]
    (offsets, index, _), labels = by_text
    sizes = [len(texts[n]) for n in (1, 3, 127, 63)]
    want = quality.metadata_view(pd.DataFrame({"size_": sizes}), [])[1]
    assert sorted(zip(labels.tolist(), index.tolist(), strict=True)) == sorted(zip([0, 0, 1, 1], want.tolist(), strict=True))
    assert offsets.tolist() == [0, 1, 2, 3, 4] and by_meta is None


def test_the_sample_takes_few_bytes_a_word_of_the_driver(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(1000)), "en", "s", 50) for i in range(300)]
    docs, known = spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    tracemalloc.start()
    frame, _ = quality._sample(docs, known, ["quality", "toxic"], [], "text", "doc_id")
    words, _ = quality._features(frame, [])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words[1]) > 500_000 and most < 24 * len(words[1])
    one = quality.text_view(pa.array([rows[frame["key"][0]][1]]))
    assert words[1][: words[0][1]].tolist() == one[1].tolist() and words[2][0].tolist() == one[2][0].tolist()


def test_a_fit_takes_its_words_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 9000, 1500)).astype(np.int32) for _ in range(1500)]
    offsets, index = np.append(0, np.cumsum([len(x) for x in rows])), np.concatenate(rows)
    stats, y = rng.normal(size=(1500, quality.STATS)), rng.integers(0, 2, 1500)
    tracemalloc.start()
    whole = quality.fit_linear(offsets, index, stats, y, np.ones(1500), quality.BUCKETS, steps=3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(index) > 2_000_000 and most < 24 * len(index)
    monkeypatch.setattr(quality, "FIT_WORDS", 100_003)
    parts = quality.fit_linear(offsets, index, stats, y, np.ones(1500), quality.BUCKETS, steps=3)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.dense, parts.dense) and np.isclose(whole.bias, parts.bias)
    taken = quality._take((offsets, index, stats), np.array([7, 3]))
    assert taken[1].tolist() == [*rows[7].tolist(), *rows[3].tolist()] and taken[0].tolist() == [0, len(rows[7]), len(rows[7]) + len(rows[3])]
    assert len(quality._take((offsets, index, stats), np.zeros(0, int))[1]) == 0
