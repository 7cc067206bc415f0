"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens; the distinct ones of a slice lie in ragged numpy
arrays of symbols. In each round every sequence applies its own lowest-rank pair at all
its places at once, until no pair has a rank. A text's count is the sum of what survives.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, text_slices

#: The pattern of the byte-level pre-tokenizer. \s there is the Unicode property White_Space.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
CACHED = 400_000  # distinct pre-tokens a worker remembers
MERGE_BYTES = 1 << 20  # bytes of pre-tokens merged at once


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in kept}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return [letters[b] for b in range(256)]


class RankMerger:
    """Counts the symbols that byte-pair merging leaves of byte strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.first = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = len(pairs)
        # Open addressing: a pair's rank is found in one or two probes.
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, self.none, dtype=np.int32)
        todo, probe = np.arange(len(keys)), 0
        while len(todo):
            slot = (self._slot(keys[todo]) + probe) & (size - 1)
            free = self.keys[slot] == -1
            _, lead = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[lead]
            self.keys[slot[won]], self.ranks[slot[won]] = keys[todo[won]], todo[won]
            todo, probe = np.delete(todo, won), probe + 1
        self.probes, self.merged = probe, merged

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        slot, out = self._slot(keys), np.full(len(keys), self.none, dtype=np.int32)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            at = self.keys[slot]
            hit = at == keys[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            more = ~hit & (at != -1)
            if not more.any():
                break
            open_, slot = open_[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols each byte string ends with."""
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        result = np.zeros(len(tokens), dtype=np.int64)
        symbols = self.first[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbols):
            same = seq[:-1] == seq[1:]
            ranks = np.full(len(symbols), self.none, dtype=np.int32)
            ranks[:-1][same] = self.rank(symbols[:-1][same], symbols[1:][same])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            lowest = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            done = lowest == self.none
            result[seq[starts[done]]] = lengths[done]
            lowest = np.repeat(lowest, lengths)
            chosen = (ranks == lowest) & (lowest != self.none)
            # Of overlapping places of one pair (aaa), every second one from the left merges.
            lone = chosen[1:] & chosen[:-1] & same
            if lone.any():
                run = np.flatnonzero(np.concatenate([[True], ~lone]))
                place = np.arange(len(symbols)) - np.repeat(run, np.diff(np.append(run, len(symbols))))
                chosen &= place % 2 == 0
            symbols[chosen] = self.merged[ranks[chosen]]
            gone = np.zeros(len(symbols), dtype=bool)
            gone[1:] = chosen[:-1]
            keep = ~gone & (lowest != self.none)
            symbols, seq = symbols[keep], seq[keep]
        return result


@lru_cache(maxsize=4)
def _merger(path: str) -> tuple[RankMerger, dict[str, int]]:
    return RankMerger(path), {}


def count_texts(texts: list[str | None], path: str) -> np.ndarray:
    """Tokens of each text; null counts as empty. Special strings in a text are one token each."""
    merger, known = _merger(path)
    if len(known) > CACHED:
        known.clear()
    special = regex.compile("|".join(map(regex.escape, merger.special))) if merger.special else None
    find = regex.compile(PRETOKEN).findall
    parts: list[list[str]] = []
    out = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        pieces = special.split(text) if text and special and special.search(text) else [text or ""]
        out[i] = len(pieces) - 1
        parts.append(find(pieces[0]) if len(pieces) == 1 else [t for p in pieces for t in find(p)])
    new = list(set().union(*parts).difference(known)) if parts else []
    at = 0
    while at < len(new):
        batch, size = [], 0
        while at < len(new) and (not batch or size < MERGE_BYTES):
            batch.append(new[at].encode())
            size += len(batch[-1])
            at += 1
        known.update(zip(new[at - len(batch) : at], merger.count(batch).tolist(), strict=True))
    for i, part in enumerate(parts):
        out[i] += sum(map(known.__getitem__, part))
    return out


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, text: str = "text") -> DataFrame:
    """docs without its text, plus n_bytes, n_tokens and over_limit (more than limit tokens).

    One pass and no shuffle. Null and empty texts have 0 bytes and 0 tokens; repeated rows give
    repeated results; an empty table gives an empty one. Input columns named like a result column are
    left out. tokenizer is the path of a byte-level vocabulary, the same on every executor.
    """
    bounded_batches(docs.sparkSession)
    results = ("n_bytes", "n_tokens", "over_limit")
    others = [c for c in docs.columns if c != text and c.lower() not in results]
    held = fresh(others, "text_")
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long").alias("n_bytes"), F.col(f"`{text}`").cast("string").alias(held))
    schema = source.drop(held).withColumn("n_tokens", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, held):
            at = part.schema.get_field_index(held)
            counts = pa.array(count_texts(part.column(at).to_pylist(), tokenizer))
            columns = [part.column(i) for i in range(part.num_columns) if i != at]
            names = [n for i, n in enumerate(part.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, counts], names=[*names, "n_tokens"])

    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
