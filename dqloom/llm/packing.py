"""Packing of tokenised documents into sequences of a fixed capacity.

First-fit decreasing, with a tournament tree over the bins' free capacity, runs
independently in randomised groups of pieces; sequences never cross groups.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bounded_batches, fresh, span_hashes, text_bytes, text_slices, tidy, written

CAPACITY = 2048
GROUP_PIECES = 8192  # pieces that are packed together, on average
CACHED = 1_000_000  # distinct units whose ids (some 50 bytes each) a task remembers


#: Of each byte: 0 blank, 1 letter, 2 other ASCII, 3 a sign that may join its neighbours to one pre-token.
KIND = np.full(256, 3, np.uint8)
KIND[:128] = 2
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[[ord("'"), ord("<"), *range(0, 9), *range(14, 32), 127]] = 3


class WordIds:
    """Ids of texts by way of their distinct units, found by 64-bit hashes of byte runs.

    The tokenizer drops white space between pre-tokens, so a text's ids are those of its blank-separated
    words in order. In a word of ASCII and Latin-1 letters and plain signs, each run of letters, lower-cased, and each run
    of other signs is a unit, as no pre-token crosses them. Any other word is one unit and goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and the library's threads never give their memory back
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)  # for a pre-token that is normalised already
        self.letters.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _units(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to read units from, each unit's start, end and kind, and the rows' offsets in units."""
        raw, offsets = text_bytes(col)
        n = len(raw)
        kind, low = KIND[raw], LOWER[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3) if n else np.zeros(0, np.int64)
        second = raw[lead + 1]
        letter = (second != 0x97) & (second != 0xB7)
        kind[lead[letter]] = kind[lead[letter] + 1] = 1
        upper = lead[letter & (second < 0x9F)] + 1
        low[upper] += 0x20
        first_of_row = np.zeros(n + 1, bool)
        first_of_row[offsets[:-1]] = True
        filled = kind > 0
        begin = filled.copy()
        begin[1:] &= ~filled[:-1] | first_of_row[1:n]
        words = np.flatnonzero(begin)
        if len(words):
            odd = np.repeat(np.maximum.reduceat(kind, words) == 3, np.diff(np.append(words, n))) & filled[words[0] :]
            kind[words[0] :][odd] = 3
            low[words[0] :][odd] = raw[words[0] :][odd]
        begin[1:] |= filled[1:] & (kind[1:] != kind[:-1])
        start = np.flatnonzero(begin)
        last = filled.copy()
        last[:-1] &= ~filled[1:] | begin[1:]
        return low, start, np.flatnonzero(last) + 1, kind[start] if n else kind, np.searchsorted(start, offsets)

    def encode(self, col: pa.Array) -> list[np.ndarray]:
        """Ids of each row; null counts as empty."""
        if len(self.known) > CACHED:
            self.clear()
        data, start, end, kind, offsets = self._units(col)
        hashes, at, back = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != hashes[inside]
        if new.any():
            self._learn(hashes[new], place[new], data.tobytes(), start[at[new]], end[at[new]], kind[at[new]])
            place = np.searchsorted(self.known, hashes)
        unit = place[back]
        size = self.size[unit]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[unit] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.append(0, ends)[offsets]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _learn(self, hashes, place, data: bytes, start, end, kind) -> None:
        units = [data[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        ids: list = [None] * len(units)
        for rows, tokenizer in ((np.flatnonzero(kind == 1), self.letters), (np.flatnonzero(kind != 1), self.tokenizer)):
            rows = rows.tolist()
            for i, e in zip(rows, tokenizer.encode_batch_fast([units[i] for i in rows], add_special_tokens=False), strict=True):
                ids[i] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known = np.insert(self.known, place, hashes)
        self.start = np.insert(self.start, place, len(self.flat) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


class TournamentTree:
    """Free capacity of bins; the leaf that first_fit returns is the first with enough room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        best[at] -= size
        leaf = at - self.leaves
        while at > 1:
            at //= 2
            left, right = best[2 * at], best[2 * at + 1]
            best[at] = left if left > right else right
        return leaf


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; longer ones come first, ties in the given order."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    full = int((sizes == capacity).sum())
    bins[order[:full]] = np.arange(full)
    tree = TournamentTree(len(sizes) - full, capacity)
    used = np.zeros(tree.leaves, np.int64)
    for i in order[full:].tolist():
        size = int(sizes[i])
        leaf = tree.first_fit(size)
        bins[i], offsets[i] = full + leaf, used[leaf]
        used[leaf] += size
    return bins, offsets


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: key, start, length, ids_crc32, doc_tokens (and ids)."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(tokenizer)
        for part in text_slices(batches, "text"):
            rows, starts, lengths, crcs, totals, kept = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(part.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for a in range(0, len(ids), capacity):
                    piece = ids[a : a + capacity]
                    rows.append(i)
                    starts.append(a)
                    lengths.append(len(piece))
                    crcs.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
                    if with_ids:
                        kept.append(piece.astype(np.int32))
            columns = [part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.clear()  # the worker lives on
        tidy()

    return source.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces, a written table, plus sequence_id and offset.

    Pieces are dealt to groups of about group_pieces at random, by place in the table, so equal
    keys don't meet in one group. Every piece of 1 to capacity tokens lands in one sequence.
    """
    count = pieces.count()
    groups = max(1, -(-count // group_pieces))
    names = pieces.columns
    group, place = fresh(names, "group_"), fresh(names, "place_")
    dealt = pieces.withColumn(place, F.monotonically_increasing_id()).withColumn(group, F.pmod(F.xxhash64(place), F.lit(groups)))
    schema = pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(place, kind="stable")
        bins, offsets = first_fit_decreasing(frame[length].to_numpy(), capacity)
        return frame[names].assign(sequence_id=bins + int(frame[group].iloc[0]) * (1 << 32), offset=offsets) if len(frame) else frame

    return dealt.groupBy(group).applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, text: str = "text", key: str = "doc_id", with_ids: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most capacity tokens.

    A document is its text's ids and end_id; null text counts as empty, so each row has a
    piece at least. Rows with equal or null keys are separate documents. Other columns don't
    matter; an empty table gives no pieces. with_ids adds each piece's ids (array<int>).
    """
    return pack(written(tokenised_pieces(docs, tokenizer, capacity, end_id, text, key, with_ids), "pieces"), capacity, group_pieces=group_pieces)
