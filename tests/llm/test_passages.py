import random

from dqloom.llm import paragraph_dedup

from .helpers import table

RNG = random.Random(11)


def words(n):
    return ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randrange(3, 8))) for _ in range(n)]


def lines(count, size):
    return "\n".join(" ".join(words(size)) for _ in range(count))


def sentences(sizes):
    return " ".join(" ".join(words(n)) + "." for n in sizes)


def flagged(spark, texts):
    return {r.doc_id: r for r in paragraph_dedup.repeated_passages(table(spark, texts)).collect()}


def test_passages_of_short_paragraphs(spark):
    verse, mixed, apart = lines(20, 3), sentences([9, 2, 3, 8, 2, 2, 9, 3, 2, 8, 2, 3, 9]), sentences([7, 1, 2, 2] * 9)
    texts = [sentences([8] * 4) + f"\n{p}\n" + sentences([8] * 4) for p in (verse, verse, mixed, mixed, apart, apart)]
    got = flagged(spark, [*texts, lines(30, 3), sentences([9, 2, 3] * 6)])
    assert {i for i, r in got.items() if r.has_repeat} == {0, 1, 2, 3, 4, 5}
    assert got[0].removed_words == 0 and all(45 <= got[i].removed_words <= n for i, n in ((1, 60), (3, 62), (5, 108)))


def test_short_paragraphs_that_differ_still_end_a_stretch(spark):
    a, b = sentences([12]), sentences([12, 7])
    got = flagged(spark, [f"{a}\n{lines(30, 3)}\n{b}" for _ in range(2)])
    assert not any(r.has_repeat for r in got.values())


def test_passages_at_arbitrary_words(spark):
    texts = []
    for sizes in ([90], [30, 40], [14, 13, 12, 14, 13]):
        passage = sentences(sizes).split(" ")[1:52]
        for _ in range(2):
            texts.append(" ".join([*words(40), *passage, *words(40)]))
    texts += [" ".join(words(131)) for _ in range(3)]
    got = flagged(spark, texts)
    assert {i for i, r in got.items() if r.has_repeat} == set(range(6))
    assert all((got[i].removed_words > 0) == (i % 2 == 1) for i in range(6))
    for i in (1, 3, 5):
        assert all(40 <= s.start and s.start + s.length <= 91 for s in got[i].spans)
