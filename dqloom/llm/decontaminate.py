"""Benchmark decontamination by winnowing.

Both sides keep, of every SPAN - GRAM + 1 consecutive word k-grams, the one with the smallest
hash. A span of SPAN words that both have holds such a run of k-grams, the same on both sides,
so the same fingerprint is kept: no shared span is missed. Each shared fingerprint is extended
word by word, and runs of SPAN words or more count. Items too short for that are
looked up whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, bounded_batches, fresh, text_slices, tidy

SPAN, GRAM = 10, 6
BLOCK_BYTES = 8 << 20  # benchmark text that is indexed and broadcast at once; more makes more blocks


def fingerprints(words: Words, gram: int, span: int) -> np.ndarray:
    """Places of the k-grams that are the smallest of some window of span - gram + 1."""
    width = span - gram + 1
    hashes, fits = words.grams(gram)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    lowest = hashes[:n].copy()
    for j in range(1, width):
        np.minimum(lowest, hashes[j : j + n], out=lowest)
    whole = fits[width - 1 :] & (words.row[:n] == words.row[width - 1 :])
    chosen = np.zeros(len(hashes), bool)
    for j in range(width):
        chosen[j : j + n] |= whole & (hashes[j : j + n] == lowest)
    return np.flatnonzero(chosen)


class BenchmarkIndex:
    """Sorted fingerprints of a block of items, and whole short items by their number of words."""

    def __init__(self, ids: list[str], texts: list[str | None], gram: int = GRAM, span: int = SPAN):
        self.ids, self.gram, self.span = ids, gram, span
        self.words = w = Words(pa.array(texts, pa.string()), ALNUM)
        self.words.row = w.row.astype(np.int32)
        at = fingerprints(w, gram, span)
        hashes = w.grams(gram)[0][at]
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at = hashes[order], at[order]
        sizes = np.diff(w.offsets)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, span):
            rows = np.flatnonzero(sizes == n)
            if len(rows):
                hashes = w.grams(n)[0][w.offsets[rows]]
                order = np.argsort(hashes, kind="stable")
                self.short[n] = hashes[order], rows[order]

    def spans(self, docs: Words) -> dict[int, list[tuple[int, int, int]]]:
        """By row: (item, first word of the row, words) of each run that the row shares with an item."""
        out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        if len(self.hashes):
            places = fingerprints(docs, self.gram, self.span)
            hashes = docs.grams(self.gram)[0][places]
            low = np.searchsorted(self.hashes, hashes, "left")
            hit = self.hashes[np.minimum(low, len(self.hashes) - 1)] == hashes
            places, low = places[hit], low[hit]
            high = np.searchsorted(self.hashes, hashes[hit], "right")
            reached: dict[tuple[int, int], int] = {}
            row = -1
            for p, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
                if docs.row[p] != row:
                    row = int(docs.row[p])
                    reached.clear()
                for q in self.at[a:b].tolist():
                    if reached.get((q - p, 0), -1) > p:
                        continue
                    start, size = self._extend(docs, p, q)
                    reached[q - p, 0] = start + size
                    if size >= self.span:
                        out[row].append((int(self.words.row[q]), start - int(docs.offsets[row]), size))
        for n, (known, rows) in self.short.items():
            hashes, fits = docs.grams(n)
            places = np.flatnonzero(fits)
            hashes = hashes[places]
            low = np.searchsorted(known, hashes, "left")
            hit = known[np.minimum(low, len(known) - 1)] == hashes
            for p, a, h in zip(places[hit].tolist(), low[hit].tolist(), hashes[hit], strict=True):
                while a < len(known) and known[a] == h:
                    q = int(self.words.offsets[rows[a]])
                    if _same(docs, p, self.words, q, n):
                        row = int(docs.row[p])
                        out[row].append((int(rows[a]), p - int(docs.offsets[row]), n))
                    a += 1
        return out

    def _extend(self, docs: Words, p: int, q: int) -> tuple[int, int]:
        """The longest equal run of words around word p of docs and word q of the items."""
        other, row, item = self.words, docs.row[p], self.words.row[q]
        room = min(p - docs.offsets[row], q - other.offsets[item])
        differ = np.flatnonzero(docs.hash[p - room : p] != other.hash[q - room : q])
        back = int(room - differ[-1] - 1) if len(differ) else int(room)
        room = min(docs.offsets[row + 1] - p, other.offsets[item + 1] - q)
        differ = np.flatnonzero(docs.hash[p : p + room] != other.hash[q : q + room])
        ahead = int(differ[0]) if len(differ) else int(room)
        size = back + ahead
        if size and not _same(docs, p - back, other, q - back, size):  # a collision of two words' hashes
            return p, 0
        return p - back, size


def _same(a: Words, i: int, b: Words, j: int, n: int) -> bool:
    """Whether n words are equal byte by byte."""
    x = [bytes(a.data[s:e]) for s, e in zip(a.start[i : i + n].tolist(), a.end[i : i + n].tolist(), strict=True)]
    return x == [bytes(b.data[s:e]) for s, e in zip(b.start[j : j + n].tolist(), b.end[j : j + n].tolist(), strict=True)]


def _covered(spans: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, n in sorted(spans):
        total += max(0, a + n - max(a, end))
        end = max(end, a + n)
    return total


SPANS = "array<struct<item_id:string,start:bigint,length:bigint>>"


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", keep_text: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs plus n_words, n_hit (words inside a run) and spans (item_id, first word, words).

    Items are indexed in blocks of about block_bytes of text, one pass over the documents for each block and
    no shuffle; what is broadcast never exceeds a block (or one item). Null and empty texts have no words. Items without words
    match nothing; repeated items count under their id. A null item_id counts as the empty string. Repeated
    documents give repeated results; empty tables are fine. Columns of docs named like a result column are left out,
    and so is the text unless keep_text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.coalesce(F.col(f"`{item_key}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{item_text}`").cast("string").alias("text")).where("octet_length(text) > 0")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    results = ("n_words", "n_hit", "spans")
    others = [c for c in docs.columns if c != text and c.lower() not in results]
    held = fresh([*others, *results], "text_")
    state = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias(held), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.expr(f"cast(array() as {SPANS})").alias("spans"))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).distinct().orderBy("id", "text").collect()
        index = spark.sparkContext.broadcast(BenchmarkIndex([r.id for r in rows], [r.text for r in rows]))
        state = state.mapInArrow(_marker(index, held), state.schema)
    names = [F.col(f"`{c}`") for c in [*others, *results]]
    return state.select(*names, F.col(held).alias(text)) if keep_text else state.select(*names)


def _marker(index, held: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, held):
            names = part.schema.names
            words = Words(part.column(names.index(held)), ALNUM)
            found = index.value.spans(words)
            spans = part.column(names.index("spans"))
            hits = part.column(names.index("n_hit"))
            if found:
                ids, spans, hits = index.value.ids, spans.to_pylist(), hits.to_pylist()
                for row, more in found.items():
                    more = [(ids[i], s, n) for i, s, n in more]
                    spans[row] = sorted({*((x["item_id"], x["start"], x["length"]) for x in spans[row]), *more})
                    spans[row] = [{"item_id": i, "start": s, "length": n} for i, s, n in spans[row]]
                    hits[row] = _covered([(x["start"], x["length"]) for x in spans[row]])
                spans, hits = pa.array(spans, part.schema.field("spans").type), pa.array(hits, pa.int64())
            new = {"n_words": pa.array(np.diff(words.offsets).astype(np.int64)), "n_hit": hits, "spans": spans}
            yield pa.RecordBatch.from_arrays([new.get(n, part.column(i)) for i, n in enumerate(names)], schema=part.schema)
        tidy()

    return run


def judged(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return contaminated_spans(docs.select(key, names.get("text", "text")), benchmark, **names).select(
        key, "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs, all columns, that share no window with the benchmark."""
    spans = fresh(docs.columns, "spans_")
    names = {c: fresh(docs.columns, f"{spans}{i}") for i, c in enumerate(docs.columns) if c != text and c.lower() in ("n_words", "n_hit", "spans")}
    marked = contaminated_spans(docs.withColumnsRenamed(names), benchmark, text=text, keep_text=True).where("n_hit = 0")
    return marked.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def judged_sql() -> str:
    """judged() without spans, for documents and benchmark, in DuckDB's SQL."""
    words = "regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words.format(t='text')} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words.format(t='text')} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), {SPAN}) AS n, array_to_string(w[i : i + least(len(w), {SPAN}) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, places.n, item_id FROM places JOIN windows USING (n, g)),
covered AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
