"""Substring deduplication by MinHash banding of paragraphs, and of word runs that need no paragraph.

A paragraph ends with its line, after some sentence ends and after some pairs of words, both chosen by their hashes, so a
passage put into other prose is cut at the same words. MinHash bands of three rows join paragraphs that collide; exact Jaccard of
their word shingles verifies each pair; components are the clusters. Boundaries can still cut a passage's edges off, so runs of
RUN words are compared wherever they stand: of the runs in each window of WINDOW, the one of the smallest hash is
looked up. Equal texts of RUN + WINDOW - 1 = 49 words share one with certainty, and where what runs cover is
too short to tell, all windows of PASSAGE words around them are looked up.

A stretch of PASSAGE words or more, each in a clustered paragraph, a shared run or a shared window, is a
repeated passage. The first place of everything stays, the other places are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, NON_SPACE, Words, _powers, bounded_batches, discard, fresh, mix64, release, text_slices, tidy, written
from .components import components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 10, 3  # a pair at 0.8 collides in some band with 1 - (1 - 0.8 ** 3) ** 10 = 0.9992, one at 0.3 with 0.24
WORDS_LEAST = 20  # words of a paragraph that is compared; shorter ones are left to runs
PASSAGE = 50  # words of a repeated passage, at least
RUN, WINDOW = 25, 25  # words of a run that is compared wherever it stands, and runs of which one is chosen
ADDRESS_ROWS = 4_000_000  # hashes of texts (8 bytes each) that may be broadcast, so only the texts asked for are shuffled
HUBS = 2  # rounds in which paragraphs of a band meet one of them, before pairs of what is still apart
RUN_SALT, WINDOW_SALT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA24BAED4963EE407)
SALTS = [0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) for i in range(BANDS * ROWS)]
MINIMA, BITS = [f"m{i}" for i in range(BANDS)], [f"s{i}" for i in range(4)]


class Paragraphs:
    """Paragraphs of WORDS_LEAST words or more of a slice of texts (first word, end, row, digest), and its runs."""

    def __init__(self, col: pa.Array):
        self.words = w = Words(col, NON_SPACE)
        n = len(w.hash)
        self.sizes = np.diff(w.offsets)
        up, self._down = _powers(n + 1)
        with np.errstate(over="ignore"):
            self._total = np.append(np.zeros(1, np.uint64), np.cumsum(w.hash * up[:n], dtype=np.uint64))
        start = end = np.zeros(0, np.int64)
        if n:
            lines = np.cumsum(w.data == 10)[w.start]
            last = w.data[w.end - 1]
            stops = (last == ord(".")) | (last == ord("!")) | (last == ord("?"))
            begins = np.ones(n, bool)
            begins[1:] = (stops & (w.hash & np.uint64(3) == 0))[:-1] | (lines[1:] != lines[:-1]) | (w.row[1:] != w.row[:-1])
            two, fits = w.grams(2)  # pairs of one row alone, so a text is cut alike whatever stands beside it in a slice
            begins[2:] |= (fits & (two & np.uint64(63) == 0))[:-2]
            start = np.flatnonzero(begins)
            end = np.append(start[1:], n)
        long = end - start >= WORDS_LEAST
        self.start, self.end = start[long], end[long]
        self.row = w.row[self.start]
        self.digest = self.digests(self.start, self.end).view(np.int64)

    def digests(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the words from each start to its end."""
        with np.errstate(over="ignore"):
            return mix64((self._total[end] - self._total[start]) * self._down[start] + (end - start).astype(np.uint64))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and digests of the chosen runs."""
        row, m = self.words.row, len(self.words.hash) - RUN + 1
        if m < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(m)
        value = self.digests(at, at + RUN) ^ RUN_SALT
        best, width = at, 1
        while width < WINDOW:
            shift = min(width, WINDOW - width)
            left, right = best[: len(best) - shift], best[shift:]
            best, width = np.where(value[left] <= value[right], left, right), width + shift
        chosen = np.unique(best[row[: len(best)] == row[RUN + WINDOW - 2 :]])
        return chosen, value[chosen].view(np.int64)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word shingles of all words, and the bounds of each paragraph among them, one after the other."""
        return self.words.grams(SHINGLE)[0], np.stack([self.start, self.end - SHINGLE + 1], axis=1).ravel()

    def bands(self) -> list[np.ndarray]:
        """The MinHash bands of the paragraphs."""
        hashes, bounds = self.shingles()
        out = []
        for band in range(BANDS):
            key = np.full(len(self.start), band, np.uint64)
            for salt in SALTS[band * ROWS : (band + 1) * ROWS]:
                with np.errstate(over="ignore"):
                    mixed = (hashes ^ np.uint64(salt)) * np.uint64(salt | 1)
                    mixed ^= mixed >> np.uint64(32)
                    least = np.minimum.reduceat(np.append(mixed, np.uint64(0)), bounds)[::2] if len(bounds) else key
                    key = key * np.uint64(0xD6E8FEB86659FD93) + least
            out.append(mix64(key).view(np.int64))
        return out

    def bits(self) -> list[np.ndarray]:
        """256-bit signatures of the shingles of the paragraphs, in four words."""
        hashes, bounds = self.shingles()
        place, one = hashes >> np.uint64(62), np.uint64(1) << (hashes & np.uint64(63))
        parts = [np.append(np.where(place == np.uint64(i), one, np.uint64(0)), np.uint64(0)) for i in range(4)]
        return [(np.bitwise_or.reduceat(p, bounds)[::2] if len(bounds) else np.zeros(0, np.uint64)).view(np.int64) for p in parts]

    def distinct(self) -> np.ndarray:
        """The number of distinct shingles of the paragraphs."""
        hashes, bounds = self.shingles()
        start, size = bounds[::2], bounds[1::2] - bounds[::2]
        ends = np.cumsum(size)
        unit = np.repeat(np.arange(len(size)), size)
        value = hashes[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        order = np.lexsort((value, unit))
        unit, value = unit[order], value[order]
        new = np.ones(len(unit), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (value[1:] != value[:-1])
        return np.bincount(unit[new], minlength=len(size)).astype(np.int64)


def _lists(row: np.ndarray, rows: int, fields: dict[str, np.ndarray]) -> pa.ListArray:
    """A list of structs for each row; row tells each struct's row, in order."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields)))


def unit_rows(source: DataFrame) -> DataFrame:
    """Per row: key, address, row, n_words, its runs and its paragraphs."""
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            names = part.schema.names
            p = Paragraphs(part.column(names.index("text")))
            at, digest = p.runs()
            first = p.words.offsets
            runs = _lists(p.words.row[at], part.num_rows, {"start": at - first[p.words.row[at]], "digest": digest})
            paras = _lists(p.row, part.num_rows, {"start": p.start - first[p.row], "words": p.end - p.start, "digest": p.digest, "size": p.distinct(), **dict(zip(MINIMA, p.bands(), strict=True)), **dict(zip(BITS, p.bits(), strict=True))})
            yield pa.RecordBatch.from_arrays([*(part.column(names.index(c)) for c in ("key", "address", "row")), pa.array(p.sizes.astype(np.int64)), runs, paras], names=["key", "address", "row", "n_words", "runs", "paras"])
        tidy()

    numbers = ", ".join(f"{c}: bigint" for c in ("start", "words", "digest", "size", *MINIMA, *BITS))
    return source.mapInArrow(run, f"key {kind}, address bigint, row bigint, n_words bigint, runs array<struct<start: bigint, digest: bigint>>, paras array<struct<{numbers}>>")


def _texts(source: DataFrame, places: DataFrame, documents: DataFrame) -> DataFrame:
    """row, key, starts (a list) and text of the documents of places: row and start."""
    starts = places.groupBy("row").agg(F.collect_list("start").alias("starts"))
    targets = written(starts.join(documents.select(F.col("key").alias("key_"), F.col("address").alias("address_"), "row"), "row"), "targets")
    n_places, n_texts = targets.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0)), F.count("*")).first()
    small = n_places <= BROADCAST_ROWS
    if not small and n_texts <= ADDRESS_ROWS:  # else all texts meet their places by a shuffle
        source = source.join(F.broadcast(targets.select(F.col("address_").alias("wanted_"))), F.col("address") == F.col("wanted_"), "left_semi")
    found = source.join(F.broadcast(targets) if small else targets, F.col("key").eqNullSafe(F.col("key_")) & (F.col("address") == F.col("address_")))
    return found.select("row", "key", "starts", "text")


def shingle_arrays(source: DataFrame, places: DataFrame, documents: DataFrame) -> DataFrame:
    """digest and sorted shingles of the paragraphs at places: row and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            p = Paragraphs(part.column(3))
            starts = part.column(2)
            places = starts.flatten().to_numpy() + p.words.offsets[np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(starts).to_numpy())]
            pick = np.searchsorted(p.start, places)
            hashes, bounds = p.shingles()
            sets = [np.unique(hashes[bounds[2 * i] : bounds[2 * i + 1]]).view(np.int64) for i in pick.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(p.digest[pick]), pa.array(sets, pa.list_(pa.int64()))], names=["digest", "shingles"])
        tidy()

    return _texts(source, places, documents).mapInArrow(run, "digest bigint, shingles array<bigint>").groupBy("digest").agg(F.first("shingles").alias("shingles"))


def _fits(a: str, b: str, percent: int) -> Column:
    """Whether sizes and signatures allow the threshold: each bit that differs is a shingle that one of the two lacks."""
    x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
    need = F.ceil(percent * (x + y) / F.lit(100.0 + percent) - 1e-9)
    differ = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in BITS])
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (differ <= x + y - 2 * need)


def verified(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of digests whose paragraphs' shingle sets reach the threshold; sets without a pair aren't moved."""
    met = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    few = pairs.count() <= BROADCAST_ROWS // 2
    arrays = arrays.join(F.broadcast(met) if few else met.hint("merge"), "digest", "left_semi")
    both = pairs.join(arrays.select(F.col("digest").alias("a"), F.col("shingles").alias("sa")), "a").join(arrays.select(F.col("digest").alias("b"), F.col("shingles").alias("sb")), "b")
    overlap = F.size(F.array_intersect("sa", "sb"))
    return written(both.where(100 * overlap >= percent * (F.size("sa") + F.size("sb") - overlap)).select("a", "b"), "verified")


def clusters(source: DataFrame, documents: DataFrame, paras: DataFrame, percent: int) -> DataFrame:
    """digest and component of the paragraphs whose cluster occurs in two documents or more."""
    kinds = paras.groupBy("digest").agg(
        F.count("*").alias("n"), F.min("row").alias("low"), F.max("row").alias("high"), F.min(F.struct("row", "start")).alias("place"), *(F.first(c).alias(c) for c in ("size", *MINIMA, *BITS)),
    )
    kinds = written(kinds, "kinds")
    release(source.sparkSession)
    bands = kinds.select(F.explode(F.array(*MINIMA)).alias("band"), "digest").repartition("band")  # dealt once for both uses
    met = bands.groupBy("band").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high").select("band")
    pairs_of = written(bands.join(met, "band"), "met")
    del bands, met
    release(source.sparkSession)
    marks = kinds.select("digest", "n", "size", *BITS)
    cells = written(pairs_of.join(marks, "digest").select("band", F.struct("n", "digest", "size", *BITS).alias("me")), "cells")
    discard(pairs_of)

    # The sets of paragraphs that meet another, made once from the texts they first stand in.
    places = kinds.join(cells.select("me.digest").distinct(), "digest", "left_semi").select("place.row", "place.start")
    arrays = written(shingle_arrays(source, places, documents), "sets")

    # Every paragraph of a band meets its hub, the most frequent one that no earlier hub has joined; then pairs of what is still apart.
    links, whole, before = None, None, None
    state = cells.withColumn("component", F.col("me.digest")).withColumn("led", F.lit(False))
    for turn in range(HUBS):
        hubs = state.where("not led").groupBy("band").agg(F.max(F.struct("me", "component")).alias("top")).select("band", F.col("top.me").alias("hub"), F.col("top.component").alias("hub_component"))
        pairs = state.join(hubs.hint("merge"), "band").where((F.col("component") != F.col("hub_component")) & _fits("hub", "me", percent)).select(F.least("hub.digest", "me.digest").alias("a"), F.greatest("hub.digest", "me.digest").alias("b")).distinct()
        pairs = written(pairs if before is None else pairs.join(before, ["a", "b"], "left_anti"), "pairs")
        before = pairs if before is None else before.unionByName(pairs)
        links = verified(pairs, arrays, percent) if links is None else links.unionByName(verified(pairs, arrays, percent))
        whole = components(links)
        # The few hubs get their component before they meet their band, so what is apart moves by digest and by band, once each.
        leaders = hubs.select("band", F.col("hub.digest").alias("node")).join(whole, "node", "left").select("band", F.coalesce("component", "node").alias("leader"))
        named = state.drop("component").withColumn("digest", F.col("me.digest")).join(whole.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
        named = named.join(leaders, "band", "left").select("band", "me", "component", (F.col("led") | (F.col("component") == F.col("leader"))).alias("led"))
        mixed = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
        state = written(named.join(mixed, "band"), f"open{turn}")
        release(source.sparkSession)
    l, r = state.alias("l"), state.alias("r")
    rest = l.join(r.hint("merge"), (F.col("l.band") == F.col("r.band")) & (F.col("l.me.digest") < F.col("r.me.digest")) & (F.col("l.component") != F.col("r.component")) & _fits("l.me", "r.me", percent))
    rest = written(rest.select(F.col("l.me.digest").alias("a"), F.col("r.me.digest").alias("b")).distinct().join(before, ["a", "b"], "left_anti"), "rest")
    whole = components(links.unionByName(verified(rest, arrays, percent)))
    named = kinds.select("digest", "low", "high").join(whole.withColumnRenamed("node", "digest"), "digest", "left").where("component is not null or low < high").withColumn("component", F.coalesce("component", "digest"))
    named = written(named, "classes")
    across = named.groupBy("component").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("component")
    out = written(named.select("digest", "component").join(across, "component"), "clusters")
    discard(kinds, cells, arrays, state, named)
    return out


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (row, key, start, words, digest) whose digest two documents have, with the digest as component; of those rows alone."""
    met = written(rows.groupBy("digest").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("digest"), "shared")
    return rows.join(met, "digest").withColumnRenamed("digest", "component")


def _with_stays(marks: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """marks, or those of them asked for, and whether each is the first place of its component: of the smallest key, nulls last."""
    first = marks.groupBy("component").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row", "start")).alias("first"))
    first = written(first.select("component", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")), "firsts")
    return (marks if asked is None else asked).join(first.hint("merge"), "component").select("row", "key", "start", "words", "component", "kind", ((F.col("first_row") == F.col("row")) & (F.col("first_start") == F.col("start"))).alias("stays"))


def _stretches(marks: DataFrame) -> DataFrame:
    """marks with their stretch (marks of a row that touch or overlap), its first word and end."""
    inside = Window.partitionBy("row").orderBy("start", "words")
    reach = F.max(F.col("start") + F.col("words")).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    numbered = marks.withColumn("opens", (reach.isNull() | (F.col("start") > reach)).cast("int")).withColumn("stretch", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("row", "stretch")
    return numbered.withColumn("since", F.min("start").over(whole)).withColumn("until", F.max(F.col("start") + F.col("words")).over(whole)).drop("opens")


def windows_around(source: DataFrame, documents: DataFrame, runs: DataFrame, passage: int) -> DataFrame:
    """row, key, start, words, digest of all windows of passage words around the runs (row, start) given."""
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            p = Paragraphs(part.column(3))
            starts, first = part.column(2), p.words.offsets
            at = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(starts).to_numpy())
            places = (starts.flatten().to_numpy() + first[at])[:, None] - np.arange(passage - RUN + 1)
            row = np.broadcast_to(at[:, None], places.shape)
            fits = (places >= first[row]) & (places + passage <= first[row + 1])
            places, back = np.unique(places[fits], return_index=True)
            row = row[fits][back]
            digest = (p.digests(places, places + passage) ^ WINDOW_SALT).view(np.int64)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(places - first[row]), pa.array(digest)], names=["row", "key", "start", "digest"])
        tidy()

    found = _texts(source, runs, documents).mapInArrow(run, f"row bigint, key {kind}, start bigint, digest bigint")
    return found.withColumn("words", F.lit(passage).cast("long"))


def judged_documents(source: DataFrame, percent: int, passage: int) -> DataFrame:
    """Per key and address: key, address, times (rows that have both), n_words, n_repeated, repeated_words, removed_words and spans of its first row."""
    if passage < RUN + WINDOW - 1:
        raise ValueError(f"a passage has {RUN + WINDOW - 1} words at least")
    every = units = written(unit_rows(source.withColumn("row", F.monotonically_increasing_id())), "units")
    # Rows of one key and text are one document, which then repeats as a whole.
    documents = units.groupBy("key", "address").agg(F.min("row").alias("row"), F.count("*").alias("times"), F.first("n_words").alias("n_words"))
    documents = written(documents, "documents")
    again = documents.where("times > 1").select(F.col("key").alias("k"), F.col("address").alias("m"), F.col("row").alias("r"))
    few = again.count() <= BROADCAST_ROWS  # then the units, three times read, aren't shuffled
    units = units.join(F.broadcast(again) if few else again, F.col("key").eqNullSafe(F.col("k")) & (F.col("address") == F.col("m")) & (F.col("row") != F.col("r")), "left_anti")
    runs = units.select("row", "key", F.explode("runs").alias("x")).select("row", "key", "x.start", F.lit(RUN).cast("long").alias("words"), "x.digest")
    paras = units.select("row", "key", F.explode("paras").alias("x")).select("row", "key", "x.*")
    grouped = clusters(source, documents, paras, percent)
    named = paras.select("row", "key", "start", "words", "digest").join(grouped, "digest").select("row", "key", "start", "words", "component", F.lit("paragraph").alias("kind"))
    whole = documents.where("times > 1 and n_words > 0").select("row", "key", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("words"), F.xxhash64("key", "address", "row").alias("component"), F.lit("whole").alias("kind"))
    shared = _shared(runs).select("row", "key", "start", "words", "component", F.lit("run").alias("kind"))
    found = written(shared.unionByName(named).unionByName(whole), "marks")
    marks = written(_with_stays(found), "places")
    discard(every, grouped, found)

    # What runs cover of a passage may fall short of its edges: there all windows around the runs are compared, in every document that has such a run.
    short = _stretches(marks.select("row", "start", "words", "component", "kind")).where((F.col("until") - F.col("since") < passage) & (F.col("kind") == "run")).select("row", "component")
    short = written(short, "short")
    release(source.sparkSession)
    around = marks.where("kind = 'run'").join(short.select("component").distinct(), "component").select("row", "start")
    windows = written(windows_around(source, documents, around, passage), "windows")
    shared = _shared(windows).select("row", "key", "start", "words", "component", F.lit("run").alias("kind"))
    shared, asked = written(shared, "shared"), short.select("row").distinct()
    asked = shared.join(F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked, "row", "left_semi")
    more = _with_stays(shared, asked)
    marks = marks.unionByName(written(more, "more"))
    discard(windows)

    # Stretches of enough words; inside them, words of places that don't stay go, unless a run that stays has them. Paragraphs that don't stay go in full.
    passages = _stretches(marks).where(F.col("until") - F.col("since") >= passage)
    gone = F.when(F.col("stays"), F.lit(0)).otherwise(F.lit(1))
    para = (F.col("kind") == "paragraph").cast("int")
    rise = passages.select("row", "stretch", "since", "until", F.col("start").alias("at"), (gone * para).alias("p"), (gone * (1 - para)).alias("g"), (1 - gone).alias("s"))
    fall = passages.select("row", "stretch", "since", "until", (F.col("start") + F.col("words")).alias("at"), (-gone * para).alias("p"), (-gone * (1 - para)).alias("g"), (gone - 1).alias("s"))
    steps = rise.unionByName(fall).groupBy("row", "stretch", "since", "until", "at").agg(F.sum("p").alias("p"), F.sum("g").alias("g"), F.sum("s").alias("s"))
    inside = Window.partitionBy("row").orderBy("at", "stretch")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    removed = (F.sum("p").over(so_far) > 0) | ((F.sum("g").over(so_far) > 0) & (F.sum("s").over(so_far) <= 0))
    pieces = steps.withColumn("goes", removed).withColumn("next", F.lead("at").over(inside)).withColumn("breaks", (~F.coalesce(F.lag("goes").over(inside), F.lit(False))).cast("int")).withColumn("island", F.sum("breaks").over(so_far))
    spans = pieces.where("goes").groupBy("row", "island").agg(F.min("at").alias("start"), (F.max("next") - F.min("at")).alias("length")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"), F.sum("length").alias("removed_words"))
    totals = steps.groupBy("row", "stretch").agg(F.first(F.col("until") - F.col("since")).alias("words")).groupBy("row").agg(F.count("*").alias("n_repeated"), F.sum("words").alias("repeated_words"))
    return documents.join(totals, "row", "left").join(spans, "row", "left")


SPANS = "array<struct<start:bigint,length:bigint>>"


def repeated_passages(docs: DataFrame, percent: int = PERCENT, passage: int = PASSAGE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_words, n_repeated (passages), repeated_words, removed_words, has_repeat, spans, address.

    Words stand between ASCII blanks, A-Z in lower case. has_repeat tells that the document shares a passage of that many words with another one,
    the first of them included; spans (first word, words) are what is removed. Null and empty texts have no words and no repeats. Rows repeated with one
    key and text share all they have: the first is judged like any document, the others go whole if they have enough words. Texts
    count in full; an empty table gives an empty result; other columns don't matter. The first place is the one with the smallest key;
    null keys come last. Up to RUN - 1 words at each end of a long passage found by runs alone are neither counted nor removed. address is a hash of the text.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).withColumn("address", F.xxhash64("text"))
    zero, none = F.lit(0).cast("long"), F.expr(f"cast(array() as {SPANS})")
    judged = judged_documents(source, percent, passage).select(
        "key", "n_words", F.coalesce("n_repeated", zero).alias("n_repeated"), F.coalesce("repeated_words", zero).alias("repeated_words"), F.coalesce("removed_words", zero).alias("removed_words"),
        F.coalesce("spans", none).alias("spans"), "address", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("turn"),
    )
    copy, whole = F.col("turn") > 1, F.col("n_words") >= passage
    return judged.select(
        F.col("key").alias(key), "n_words", F.when(copy, whole.cast("long")).otherwise(F.col("n_repeated")).alias("n_repeated"),
        *(F.when(copy, F.when(whole, F.col("n_words")).otherwise(zero)).otherwise(F.col(c)).alias(c) for c in ("repeated_words", "removed_words")),
        F.when(copy, whole).otherwise(F.col("n_repeated") > 0).alias("has_repeat"),
        F.when(copy, F.when(whole, F.array(F.struct(zero.alias("start"), F.col("n_words").alias("length")))).otherwise(none)).otherwise(F.col("spans")).alias("spans"), "address",
    )


def without_passages(docs: DataFrame, percent: int = PERCENT, passage: int = PASSAGE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs, all columns, with the removed passages cut out of the text; its other characters stay as they are. Of rows repeated with one key and text, one keeps what the first place keeps."""
    names = list(docs.columns)
    for wanted in ("mark_", "k_", "m_", "spans_", "others_", "row_", "first_"):
        names.append(fresh(names, wanted))
    at, k, m, spans, others, row, first = names[-7:]
    judged = repeated_passages(docs, percent, passage, text, key).groupBy(F.col(key).alias(k), F.col("address").alias(m)).agg(
        F.min(F.struct("removed_words", "spans")).alias("least"), F.max(F.struct("removed_words", "spans")).alias("most")
    ).where("most.removed_words > 0")
    judged = written(judged.select(k, m, F.col("least.spans").alias(spans), F.col("most.spans").alias(others)), "cuts")
    marked = docs.withColumn(at, F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
    same = F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.col(at) == F.col(m))
    # Rows that differ only in which of them is first are numbered in a written table, so the choice holds.
    mixed = written(marked.join(judged.where(F.col(spans) != F.col(others)), same).withColumn(row, F.monotonically_increasing_id()), "mixed")
    least = mixed.groupBy(k, m).agg(F.min(row).alias(first))
    chosen = mixed.join(least.withColumnsRenamed({k: k + "1", m: m + "1"}), F.col(k).eqNullSafe(F.col(k + "1")) & (F.col(m) == F.col(m + "1")))
    chosen = chosen.withColumn(spans, F.when(F.col(row) == F.col(first), F.col(spans)).otherwise(F.col(others)))
    rest = marked.join(judged.where(F.col(spans) == F.col(others)), same, "left")
    rest = rest.join(judged.where(F.col(spans) != F.col(others)).select(F.col(k).alias(k + "1"), F.col(m).alias(m + "1")), F.col(f"`{key}`").eqNullSafe(F.col(k + "1")) & (F.col(at) == F.col(m + "1")), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = rest.select(*columns, spans).unionByName(chosen.select(*columns, spans))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            i, j = part.schema.get_field_index(text), part.schema.get_field_index(spans)
            col, removed = part.column(i).to_pylist(), part.column(j)
            rows = np.flatnonzero(pa.compute.fill_null(pa.compute.list_value_length(removed), 0).to_numpy())
            if len(rows):
                words = Words(part.column(i), NON_SPACE)
                before = np.cumsum([0, *(len((x or "").encode()) for x in col)])
                for n in rows.tolist():
                    raw, out, since = col[n].encode(), [], 0
                    for x in removed[n].as_py():
                        a = words.offsets[n] + x["start"]
                        out.append(raw[since : words.start[a] - before[n]])
                        since = words.end[a + x["length"] - 1] - before[n]
                    col[n] = b"".join([*out, raw[since:]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(col, part.column(c).type) if c == i else part.column(c) for c in range(part.num_columns) if c != j], names=[n for c, n in enumerate(part.schema.names) if c != j])

    return joined.mapInArrow(cut, docs.schema)
