import hashlib
import random
import re

from pyspark.sql import functions as F

from dqloom.llm import decontaminate

from .helpers import lower, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(texts, items):
    windows = []
    for item, t in items:
        w = re.findall(WORD, lower(t))
        windows += [(item, tuple(w[i : i + 10])) for i in range(max(1, len(w) - 9))] if w else []
    out = []
    for t in texts:
        w = re.findall(WORD, lower(t))
        hit, found = set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found.add(item)
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "a", "of", "été", "naïve", "x1", "b", "c", "日本"])
    items = [(str(i), " ".join(word() for _ in range(n))) for i, n in enumerate([25, 10, 9, 1, 3, 40, 12, 0, 11])]
    items += [("9", "same words again and again and again and again and again and again"), ("10", items[0][1]), ("7b", "!!! ...")]
    texts = [None, "", "...", items[0][1], "x " + items[5][1][:90] + " y", items[5][1].upper().replace(" ", "-"), "again and again and again and again and again and"]
    for _ in range(25):
        n = rng.randrange(5, 80)
        body = [word() for _ in range(n)]
        if rng.random() < 0.6:
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w)) if w else 0
            body[n // 2 : n // 2] = w[a : a + rng.randrange(5, 20)]
        texts.append(" ".join(body))
    return texts, items


def test_hits_match_brute_force(spark):
    for seed in (1, 2, 3):
        texts, items = made(seed)
        bench = spark.createDataFrame(items, "item_id string, text string")
        for block in (decontaminate.BLOCK_BYTES, 60):  # all at once, and in many blocks
            got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.judged(table(spark, texts), bench, block_bytes=block).collect()}
            assert [got[i] for i in range(len(texts))] == brute(texts, items)


def test_spans_cover_the_hits_in_long_texts(spark):
    body = [f"w{i}" for i in range(50_000)]
    passage = [f"q{i}" for i in range(30)]
    body[40_000:40_000] = passage
    out = decontaminate.contaminated_spans(table(spark, [" ".join(body)]), spark.createDataFrame([(1, " ".join(passage))], "item_id int, text string")).first()
    assert out.n_words == 50_030 and out.n_hit == 30 and [tuple(s) for s in out.spans] == [("1", 40_000, 30)]


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "zz"), (2, None)], "doc_id bigint, text string").withColumns({"spans": F.lit("s"), "n_hit": F.lit(7), "text_": F.lit("t")})
    bench = spark.createDataFrame([(None, "b c"), ("5", None), ("5", "b c")], "item_id string, text string")
    got = sorted(map(tuple, decontaminate.judged(docs, bench).select("doc_id", "n_words", "n_hit", "n_items").collect()), key=str)
    assert got == sorted([(1, 3, 2, 2), (1, 3, 2, 2), (None, 1, 0, 0), (2, 0, 0, 0)], key=str)
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and {(r.doc_id, r.text, r.spans, r.n_hit) for r in kept.collect()} == {(None, "zz", "s", 7), (2, None, "s", 7)}
    assert decontaminate.judged(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.judged(docs.limit(0), bench).count() == 0
