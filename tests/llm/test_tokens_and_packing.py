import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dqloom.llm import packing, token_count
from dqloom.llm.queries import tokenizer_path

from .helpers import table

TEXTS = [
    None, "", " ", "plain words, and more: it's don't I'LL we've", "  two\n\n lines \t", "123 4567 ١٢٣ ⅷ", "aaaaaaaaaaaaaaaaaaaaaaaa" * 300, "é é ẖ H̱ ÀÉß×÷ª", "日本語テキスト" * 50, "<|endoftext|>x<|endoftext|>",
    "<|startoftext|> Σίσυφος ΣΑΣ", "́ x", "a.”b <|x can\u2019t CAN'T", "\x1c\x1d a \x85 b\xa0c\u3000d", "x\x00y\x7f", "ﷺ ﬁ Å", "🙂🙃 👩‍👩‍👧", "word " * 5000, "≠ ≮ ≯ .́",
]


def library(name, texts):
    return [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_are_the_librarys(spark):
    df = table(spark, TEXTS).withColumns({"n_tokens": F.lit("clash"), "text_": F.lit(1)})
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(df, tokenizer_path("byte_bpe_50k.json")).collect()}
    want = library("byte_bpe_50k.json", TEXTS)
    assert got == {i: (len((t or "").encode()), len(want[i]), len(want[i]) > 512) for i, t in enumerate(TEXTS)}
    assert token_count.count_tokens(df.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_ids_and_pieces_are_the_librarys(spark):
    want = library("word_bpe_49k.json", TEXTS)
    rows = packing.pack_documents(table(spark, TEXTS).withColumns({"group_": F.lit(1), "length": F.lit(2)}), tokenizer_path("word_bpe_49k.json"), with_ids=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(range(len(TEXTS)))
    for i, pieces in by.items():
        pieces.sort(key=lambda r: r.start)
        assert [x for p in pieces for x in p.ids] == [*want[i], 1]
        assert [p.start for p in pieces] == list(np.cumsum([0, *[p.length for p in pieces]])[:-1])
        assert all(p.doc_tokens == len(want[i]) + 1 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) <= 2048 for p in pieces)
    check_sequences(rows)


def check_sequences(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def brute_first_fit(sizes, capacity):
    free, bins = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((j for j, f in enumerate(free) if f >= sizes[i]), None)
        if b is None:
            free.append(capacity)
            b = len(free) - 1
        free[b] -= sizes[i]
        bins.append((i, b))
    return [b for _, b in sorted(bins)]


def test_the_tournament_tree_finds_the_first_fit():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        assert bins.tolist() == brute_first_fit(sizes.tolist(), 100)
        assert all(offsets[bins == b].sum() >= 0 for b in set(bins.tolist()))


def test_little_padding_in_many_groups_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(7, int(n)) for n in rng.integers(1, 1500, 4000)], "doc_id bigint, length bigint").repartition(3)
    from dqloom.llm.common import written

    rows = packing.pack(written(df, "t"), group_pieces=1000).collect()
    used = check_sequences(rows)
    total = sum(r.length for r in rows)
    assert len(rows) == 4000 and total / (used * 2048) > 0.99
    assert packing.pack_documents(table(spark, []), tokenizer_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("tokens", [[b"a" * n for n in range(1, 40)], [b"abab" * 9, b"aab", b"baa", b"\xff\xfe"]])
def test_overlapping_pairs_merge_from_the_left(tokens):
    merger = token_count.RankMerger(tokenizer_path("byte_bpe_50k.json"))
    letters = token_count.byte_letters()
    model = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")).model
    assert merger.count(tokens).tolist() == [len(model.tokenize("".join(letters[b] for b in t))) for t in tokens]
