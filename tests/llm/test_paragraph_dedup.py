import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dqloom.llm import paragraph_dedup
from dqloom.llm.paragraph_dedup import PASSAGE, RUN, Paragraphs

from .helpers import components, lower, shingles, table

RNG = random.Random(6)


def word():
    return "".join(RNG.choices("abcdefghijklmnop", k=RNG.randrange(3, 8)))


def sentence(n):
    return " ".join([word().capitalize(), *(word() for _ in range(n - 1))]) + "."


def prose(n):
    return " ".join(sentence(RNG.randrange(6, 14)) for _ in range(n))


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]


def brute(texts):
    """By text: words in stretches of PASSAGE or more that lie in a shared run or window, or in a paragraph whose cluster (by all pairs) is in two texts."""
    words = [split(t) for t in texts]
    covered = [np.zeros(len(w), bool) for w in words]
    for n in (RUN, PASSAGE):
        seen = {}
        for d, w in enumerate(words):
            for i in range(len(w) - n + 1):
                seen.setdefault(tuple(w[i : i + n]), []).append((d, i))
        for places in seen.values():
            if len({d for d, _ in places}) > 1:
                for d, i in places:
                    covered[d][i : i + n] = True
    p = Paragraphs(pa.array([t or "" for t in texts]))
    units = [(int(r), int(a - p.words.offsets[r]), int(b - p.words.offsets[r])) for r, a, b in zip(p.row, p.start, p.end, strict=True)]
    sets = [shingles(" ".join(words[d][a:b])) for d, a, b in units]
    root = components(range(len(units)), [(i, j) for i in range(len(units)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    for c in set(root.values()):
        own = [units[i] for i in root if root[i] == c]
        if len({d for d, _, _ in own}) > 1:
            for d, a, b in own:
                covered[d][a:b] = True
    out = []
    for flags in covered:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(int), [0]]))).reshape(-1, 2)
        out.append(int(sum(b - a for a, b in edges if b - a >= PASSAGE)))
    return out


def made():
    passage, line = prose(9), sentence(12)
    near = sentence(90)
    edited = near.replace(near.split(" ")[3], "changed", 1)
    long = " ".join(word() for _ in range(120))
    words = long.split(" ")
    words[60] = "other"
    texts = [prose(10) for _ in range(6)]
    texts += [prose(4)[:-1] + " and " + passage + " " + prose(4), prose(3) + "\n" + passage + "\n" + prose(2), passage, prose(2) + " " + passage]
    texts += [prose(5) + "\n" + line, line + "\n" + prose(5), prose(2) + "\n" + near, edited + "\n" + prose(3), long, " ".join(words), None, "", "one two.", prose(3) + " " + sentence(6) * 3]
    for n in (30, 49, 50, 51, 60, 75):
        cut = [word() for _ in range(n)]
        texts += [" ".join([*(word() for _ in range(40)), *cut, *(word() for _ in range(RNG.randrange(60)))]) for _ in range(2)]
    return texts


def test_repeats_match_brute_force(spark):
    texts = made()
    ids = RNG.sample(range(1000), len(texts))
    got = {r.doc_id: r for r in paragraph_dedup.repeated_passages(table(spark, texts, ids)).collect()}
    want = dict(zip(ids, brute(texts), strict=True))
    assert {i for i, r in got.items() if r.has_repeat} == {i for i, n in want.items() if n}
    for i, r in got.items():
        assert want[i] - 2 * (RUN - 1) * r.n_repeated <= r.repeated_words <= want[i]
        assert r.removed_words <= r.repeated_words and sum(s.length for s in r.spans) == r.removed_words
    flagged = {texts.index(t) for i, t in zip(ids, texts, strict=True) if want[i]}
    assert {6, 7, 8, 9, 14, 15} <= flagged and not flagged & {*range(6), 10, 11}


def test_bands_find_nearly_all_pairs_at_the_threshold():
    texts, pairs = [], []
    for _ in range(400):
        words = [word() for _ in range(64)]
        other = list(words)
        other[30] = "changed"
        texts += [" ".join(words), " ".join(other)]
    p = Paragraphs(pa.array([re.sub(r"[.!?]", "", t) for t in texts]))
    bands = np.stack(p.bands(), axis=1)
    by_row = {}
    for i, r in enumerate(p.row):
        by_row.setdefault(int(r), []).append(i)
    words = [split(t) for t in texts]
    for r in range(0, len(texts), 2):
        for i in by_row.get(r, []):
            for j in by_row.get(r + 1, []):
                x, y = (shingles(" ".join(words[s][p.start[k] - p.words.offsets[s] : p.end[k] - p.words.offsets[s]])) for s, k in ((r, i), (r + 1, j)))
                if x != y and 100 * len(x & y) >= 80 * len(x | y):
                    pairs.append((bands[i] == bands[j]).any())
    assert len(pairs) > 50 and np.mean(pairs) >= 0.98


def test_passages_are_cut_out_and_the_first_stays(spark):
    passage = "\n".join(prose(8) for _ in range(2))
    texts = ["Start here.\n" + passage + "\nEnd one.", "Other  start.\n" + passage + "\n\tEnd two."]
    df = table(spark, texts).withColumns({"mark_": F.lit(1), "spans_": F.lit(2), "k_": F.lit(3)})
    out = {r.doc_id: r for r in paragraph_dedup.without_passages(df).collect()}
    assert out[0].text == texts[0] and out[1].asDict().keys() == set(df.columns)
    left = out[1].text
    assert left.startswith("Other  start.\n") and left.endswith("End two.") and len(split(left)) <= 4 + 2 * RUN


def test_rows_repeated_keep_what_stays_once(spark):
    passage = prose(9)
    own = "Own text A. " + passage
    rows = [(1, own, "x"), (1, own, "y"), (1, own, "z"), (2, "Other words here. " + passage, "u"), (2, prose(3), "v")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, extra string")
    got = sorted((r.text or "", r.extra) for r in paragraph_dedup.without_passages(df).collect() if r.doc_id == 1)
    assert [t for t, _ in got] == ["", "", own] and {e for _, e in got} == {"x", "y", "z"}
    counts = sorted((r.doc_id, r.removed_words > 0) for r in paragraph_dedup.repeated_passages(df).collect())
    assert counts == [(1, False), (1, True), (1, True), (2, False), (2, True)]


def test_near_copies_of_paragraphs_go_in_full(spark):
    first = " ".join(word() for _ in range(200))
    words = first.split(" ")
    for i in (20, 70, 120, 170):
        words[i] = "changed"
    got = {r.doc_id: r for r in paragraph_dedup.repeated_passages(table(spark, [first, " ".join(words), prose(20)])).collect()}
    assert got[0].has_repeat and got[1].has_repeat and not got[2].has_repeat and got[0].removed_words == 0 and got[1].removed_words >= 50


def test_groups_of_near_copies_are_one_cluster(spark):
    base = [word() for _ in range(60)]
    texts = []
    for i in range(120):
        own = list(base)
        own[i % 60] = f"edit{i}"
        texts.append(" ".join(own))
    got = paragraph_dedup.repeated_passages(table(spark, texts)).collect()
    assert all(r.has_repeat for r in got) == all(n > 0 for n in brute(texts))


def test_hot_lines_repeated_rows_null_keys_long_texts_and_empty_tables(spark):
    passage = prose(9)
    big = " ".join(word() for _ in range(40_000))
    df = spark.createDataFrame([(3, passage), (3, passage), (None, passage), (9, big), (8, big + " " + passage)] + [(100 + i, passage + " " + prose(2)) for i in range(60)], "doc_id bigint, text string")
    got = paragraph_dedup.repeated_passages(df).collect()
    assert len(got) == 65 and all(r.has_repeat for r in got)
    assert sorted(r.removed_words for r in got if r.doc_id == 3)[0] == 0 and sum(r.removed_words == 0 for r in got if r.doc_id not in (8, 9)) == 1
    assert paragraph_dedup.repeated_passages(df.limit(0)).count() == 0 and paragraph_dedup.without_passages(df.limit(0)).count() == 0


def test_a_text_is_cut_alike_whatever_stands_beside_it():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, rng.integers(1, 90))) for _ in range(600)]
    together = Paragraphs(pa.array(texts))
    begins = together.words.offsets[together.row]
    for row, text in enumerate(texts):
        alone, mine = Paragraphs(pa.array([text])), together.row == row
        assert alone.start.tolist() == (together.start - begins)[mine].tolist()
        assert alone.digest.tolist() == together.digest[mine].tolist()


def test_results_are_the_same_beyond_every_bound_of_a_broadcast(spark, monkeypatch):
    own = random.Random(11)
    passages = [prose(7) for _ in range(3)]
    texts = [f"{prose(own.randrange(1, 6))} {own.choice(passages)} {prose(2)}" for _ in range(9)] + [prose(8), None, "", prose(30)]
    source = table(spark, [*texts, texts[0]], ids=[*range(len(texts)), 0])

    def judged():
        return sorted(map(repr, paragraph_dedup.repeated_passages(source).collect()))

    want = judged()
    assert any("has_repeat=True" in r for r in want) and any("has_repeat=False" in r for r in want)
    monkeypatch.setattr(paragraph_dedup, "BROADCAST_ROWS", 0)  # the texts asked for are chosen by their hashes
    assert judged() == want
    monkeypatch.setattr(paragraph_dedup, "ADDRESS_ROWS", 0)  # all texts meet their places by a shuffle
    assert judged() == want
