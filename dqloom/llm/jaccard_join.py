"""Exact Jaccard self-join of documents on word shingles, and its connected components.

Every document's set of shingles is put in one order, common shingles last, the rest by hash.
If two sets reach the threshold, the first few shingles of each (its prefix) have one in
common, so only sets that meet in a tile (a prefix shingle and a band of set sizes) are compared:
first by set sizes, then by the bits of hashed signatures, which bound the overlap from above, and what
is left by exact intersection of sorted arrays. Sets that a first round has already
joined by way of the best-connected set of a tile aren't compared again: they can't change a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, NON_SPACE, Words, bounded_batches, keep_rows, mix64, text_slices, tidy, written
from .components import components

SHINGLE, PERCENT = 5, 80
WIDTH = 1024  # bits of a signature
COMMON_MOST = 100_000  # shingles that may be put last; more common ones come first. It sets an order and drops nothing
COMMON_FROM = 64  # documents that a common shingle is in, at least
COUNTED = 1 << 19  # shingles a task counts at once; beyond that, those seen once are forgotten
BITS = [f"s{i}" for i in range(WIDTH // 64)]


def shingle_sets(col: pa.Array, common: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by row and the sorted distinct shingles of each row, as 63-bit hashes with the top bit for common ones."""
    words = Words(col, NON_SPACE)
    hashes, fits = words.grams(k)
    sizes = np.diff(words.offsets)
    rows, values = [words.row[fits]], [hashes[fits]]
    for n in range(1, k):
        short = np.flatnonzero(sizes == n)
        if len(short):
            rows.append(short)
            values.append(words.grams(n)[0][words.offsets[short]])
    row, value = np.concatenate(rows), np.concatenate(values) >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, value), len(common) - 1)
        value |= (common[at] == value).astype(np.uint64) << np.uint64(63)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return np.searchsorted(row, np.arange(words.rows + 1)), value


def common_shingles(source: DataFrame, k: int) -> np.ndarray:
    """The shingles of most documents, sorted; at most COMMON_MOST of them.

    Tasks count by lossy counting in bounded memory. Only hashes of the lowest quarter are
    counted, as no others get into a prefix of some length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in text_slices(batches, "text"):
            _, values = shingle_sets(part.column(part.schema.get_field_index("text")), np.zeros(0, np.uint64), k)
            values = values[values < np.uint64(1 << 61)]
            both = np.concatenate([seen, values])
            weight = np.concatenate([counts, np.ones(len(values), np.int64)])
            seen, back = np.unique(both, return_inverse=True)
            counts = np.bincount(back, weights=weight, minlength=len(seen)).astype(np.int64)
            if len(seen) > COUNTED:
                seen, counts = seen[counts > 1], counts[counts > 1]
                if len(seen) > COUNTED // 2:
                    least = np.sort(counts)[-COUNTED // 2]
                    seen, counts = seen[counts >= least], counts[counts >= least]
        often = counts >= 4
        tidy()
        yield pa.RecordBatch.from_arrays([pa.array(seen[often].view(np.int64)), pa.array(counts[often])], names=["shingle", "n"])

    counted = source.select("text").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= COMMON_FROM).orderBy(F.desc("n"), "shingle").limit(COMMON_MOST)
    return np.sort(np.array([r.shingle for r in top.collect()], dtype=np.int64).view(np.uint64))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def signatures(source: DataFrame, common, k: int, percent: int) -> DataFrame:
    """Per row: key, address, row, n (set size), d1 and d2 (the set's digest), the signature's words and the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            names = part.schema.names
            offsets, values = shingle_sets(part.column(names.index("text")), common.value, k)
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            bits = np.zeros((len(n), WIDTH), bool)
            bits[row, (values % np.uint64(WIDTH)).astype(np.int64)] = True
            bits = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            digests = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                with np.errstate(over="ignore"):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(salt)), dtype=np.uint64)])
                    digests.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
            length = np.where(n > 0, prefix_length(n, percent), 0)
            ends = np.cumsum(length)
            take = np.repeat(offsets[:-1] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
            prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[take].view(np.int64)))
            kept = [part.column(names.index(c)) for c in ("key", "address", "row")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n.astype(np.int64)), *map(pa.array, digests), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(WIDTH // 64)), prefix],
                names=["key", "address", "row", "n", "d1", "d2", *BITS, "prefix"],
            )
        tidy()

    schema = f"key {source.schema['key'].dataType.simpleString()}, address bigint, row bigint, n bigint, d1 bigint, d2 bigint, {', '.join(f'{b} bigint' for b in BITS)}, prefix array<bigint>"
    return source.mapInArrow(run, schema)


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and signatures allow the overlap: a bit that differs is a shingle that one set lacks."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.ceil((percent * (x + y)) / F.lit(100.0 + percent) - 1e-9).cast("long")
    differ = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in BITS])
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (differ <= x + y - 2 * need)


def wide_signature(values: np.ndarray) -> np.ndarray:
    """Two to four bits for each shingle of the set, a power of two of them, as 64-bit words."""
    width = 4 << max(4, int(len(values)).bit_length() - 1)
    bits = np.zeros(width, bool)
    bits[(values % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """Bits that differ, the wider signature folded to the other's width. Each is a shingle of one set alone."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return int(np.bitwise_count((x ^ y).view(np.uint64)).sum())


def verified(pairs: DataFrame, nodes: DataFrame, source: DataFrame, common, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold, by intersecting the whole sorted sets.

    Sets are made again from the texts of just the rows that occur in pairs.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    wanted = nodes.join(ends, "row").select("row", F.col("key").alias("key_"), F.col("address").alias("address_")).persist()
    small = wanted.count() <= BROADCAST_ROWS
    texts = source.join(F.broadcast(wanted) if small else wanted, F.col("key").eqNullSafe(F.col("key_")) & (F.col("address") == F.col("address_"))).select(wanted["row"].alias("node"), "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            offsets, values = shingle_sets(part.column(1), common.value, k)
            wide = [wide_signature(values[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(wide, pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))], names=["node", "n", "wide", "shingles"])
        tidy()

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, wa, wb = (batch.column(i) for i in range(6))
            sizes = (na.to_numpy() + nb.to_numpy()).tolist()
            keep = pa.array([differing(wa[i].values.to_numpy(), wb[i].values.to_numpy()) <= n - 2 * -(-percent * n // (100 + percent)) for i, n in enumerate(sizes)], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    # Kept on the executors' disks, as they depend on nothing but texts: what is lost is made again.
    arrays = texts.mapInArrow(sets, "node bigint, n bigint, wide array<bigint>, shingles array<bigint>").persist(StorageLevel.DISK_ONLY)
    # Signatures as wide as the sets are large, a twentieth of their size, sort out the pairs whose sets are fetched.
    wide = pairs.join(arrays.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb")), "b").join(arrays.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa")), "a")
    likely = written(wide.select("a", "b", "na", "nb", "wa", "wb").mapInArrow(bound, "a bigint, b bigint"), "bounded")
    both = likely.join(arrays.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").join(arrays.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, sa, sb = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "sa", "sb"))
            links = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
                merged = np.sort(np.concatenate([x, y]))
                shared = int((merged[1:] == merged[:-1]).sum())
                links[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            keep = pa.array(links)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    out = written(both.select("a", "b", "sa", "sb").mapInArrow(check, "a bigint, b bigint").distinct(), "verified")
    arrays.unpersist()
    wanted.unpersist()
    return out


def _banded(tiles: DataFrame, shift: float) -> DataFrame:
    return tiles.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.3)) + F.lit(shift)).cast("int"))


def linked_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of docs: key, n_shingles, component_id, first, address.

    A set has the distinct k-word shingles of the whole text, words being what stands between ASCII blanks, A-Z
    in lower case; with fewer words the sequence is the one shingle. Sets link when 100 * intersection >=
    percent * union, and component_id is the smallest key reachable. first marks one row of each component.
    Null and empty texts have no shingles and are components of their own (component_id is their key, first is true). Equal texts, repeated
    rows among them, are one set, compared once. Null keys never become a component_id unless there is no other. Texts of
    any length count in full; an empty table gives an empty result; other columns don't matter. address is a hash of the text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).withColumn("address", F.xxhash64("text"))
    common = spark.sparkContext.broadcast(common_shingles(source, k))
    rows = written(signatures(source.withColumn("row", F.monotonically_increasing_id()), common, k, percent), "signatures")

    # Equal sets are one node, the row with the smallest key.
    classes = written(rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("first")).select("n", "d1", "d2", F.col("first.row").alias("node"), F.col("first.key").alias("node_key")), "classes")
    reps = rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    nodes = written(reps.select("row", "key", "address", "n", *BITS), "nodes")
    cells = reps.select(F.col("row").alias("node"), F.explode("prefix").alias("shingle"))
    shared = cells.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1")
    met_cells = written(cells.join(shared, "shingle"), "met-cells")
    tiles = met_cells.join(nodes.select(F.col("row").alias("node"), "n"), "node")

    # First round: each node against the best-connected node of the tiles it is in, the one it shares most with.
    degree = tiles.groupBy("node").agg(F.sum("c").alias("degree"))
    placed = tiles.join(degree, "node")
    banded = _banded(placed, 0.0).withColumn("turn", F.lit(0)).unionByName(_banded(placed, 0.5).withColumn("turn", F.lit(1)))
    hubs = banded.groupBy("shingle", "turn", "band").agg(F.max(F.struct("degree", "node")).alias("hub"), F.count("*").alias("here")).where("here > 1").select("shingle", "turn", "band", F.col("hub.node").alias("a"))
    met = banded.join(hubs, ["shingle", "turn", "band"]).where("a <> node").groupBy("node", "a").agg(F.count("*").alias("times"))
    best = met.groupBy("node").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), F.col("node").alias("b"))
    marks = nodes.select(F.col("row"), "n", *BITS)
    likely = best.join(marks.alias("x"), F.col("a") == F.col("x.row")).join(marks.alias("y"), F.col("b") == F.col("y.row")).where(may_link("x", "y", percent)).select("a", "b")
    links = verified(written(likely, "likely"), nodes, source, common, k, percent)
    joined = components(links)

    # Second round: all pairs of a tile that aren't in one component yet.
    labelled = tiles.join(joined.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")
    open_ = _banded(labelled.join(mixed, "shingle").select("shingle", "node", "component").join(marks.withColumnRenamed("row", "node"), "node"), 0.0)
    open_ = written(open_, "open-tiles")
    left = open_.withColumn("tile", F.col("band")).alias("l")
    right = open_.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") - 1))).alias("r")
    pairs = (
        left.join(right, (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.tile") == F.col("r.tile")) & (F.col("l.component") != F.col("r.component")) & ((F.col("r.band") > F.col("l.band")) | (F.col("l.node") < F.col("r.node"))) & may_link("l", "r", percent))
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        .distinct()
    )
    rest = verified(written(pairs, "pairs"), nodes, source, common, k, percent)
    whole = components(links.unionByName(rest))

    # The smallest key of each component, back to the rows.
    named = classes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min(F.struct(F.col("node_key").isNull().alias("none"), F.col("node_key").alias("key"), "node")).alias("least"))
    named = written(named.join(least, "component").select("n", "d1", "d2", F.col("least.key").alias("component_id"), F.col("least.node").alias("first_row")), "components")
    return (
        rows.select("key", "address", "row", "n", "d1", "d2")
        .join(named, ["n", "d1", "d2"], "left")
        .select(
            F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("first_row").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce(F.col("first_row") == F.col("row"), F.lit(True)).alias("first"), "address",
        )
    )


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, that come first in their component. Rows without shingles all stay."""
    judged = linked_components(docs, k, percent, text, key).select(F.col(key).alias("k"), F.col("address").alias("m"), F.col("first").alias("stays"), F.lit(1).alias("n"))
    return keep_rows(docs, key, F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), judged)


def components_sql() -> str:
    """n_shingles and component_id of documents in DuckDB's SQL: candidate pairs share a shingle, components by repeated steps."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i : i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})]) END AS g FROM d),
classes AS (SELECT min(doc_id) AS node, list_sort(g) AS g FROM s WHERE len(g) > 0 GROUP BY 2),
cells AS MATERIALIZED (SELECT node, len(g) AS n, unnest(g) AS x FROM classes),
links AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM cells a JOIN cells b ON a.x = b.x AND a.node < b.node AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT node, node FROM classes UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
least_one AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(component, s.doc_id) AS component_id
FROM s LEFT JOIN classes c ON list_sort(s.g) = c.g LEFT JOIN least_one l ON l.node = c.node"""
