"""Language identification by a byte convolutional network, trained here in numpy.

Filters of several widths run over byte embeddings; each filter's largest response in a window
of fixed length feeds a softmax. A text's score is the mean over all its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, text_bytes, text_slices, tidy

WINDOW = 256  # bytes
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 16, 8
PER_LANGUAGE = 1000  # labelled documents of a language that are trained on, about
PARTS = 3  # windows taken from each of them
LEARNED_MOST = 300_000  # labelled documents trained on in all, about; with very many languages each has fewer, but none is left out
EPOCHS, BATCH = 8, 128
TOGETHER = 512  # windows scored at once


@dataclass
class ByteNetwork:
    languages: list[str]
    tables: list[np.ndarray]  # for each width, width x 256 x FILTERS responses of a byte at each place
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pairs(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width: place and responses of two bytes together, or of the last one."""
        if not hasattr(self, "_pairs"):
            self._pairs = [[(j, (t[j][:, None] + t[j + 1][None]).reshape(65536, -1) if j + 1 < len(t) else t[j]) for j in range(0, len(t), 2)] for t in self.tables]
        return self._pairs

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """windows x (widths * FILTERS) largest responses."""
        out = []
        two = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        for t, parts in zip(self.tables, self.pairs(), strict=True):
            m = windows.shape[1] - len(t) + 1
            total = None
            for j, table in parts:
                found = np.take(table, (two if len(table) > 256 else windows)[:, j : j + m], axis=0)
                total = found if total is None else np.add(total, found, out=total)
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1) + self.bias, 0)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.pooled(windows[i : i + TOGETHER]) @ self.weights + self.offset for i in range(0, len(windows), TOGETHER)])


def windows_of(data: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of each row in windows padded with zeros: windows, row and filled bytes of each."""
    size = np.diff(offsets)
    count = -(-size // width)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    filled = np.minimum(width, size[row] - nth * width)
    out = np.zeros((len(row), width), np.uint8)
    mask = np.arange(width) < filled[:, None]
    out[mask] = data
    return out, row, filled


def train(texts: list[str], labels: list[str], seed: int = 7) -> ByteNetwork:
    """A network for the labels of texts, each text cut to one window. Languages weigh the same."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    y = np.searchsorted(languages, labels)
    x = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode()[:WINDOW], np.uint8)
        x[i, : len(b)] = b
    share = (1 / np.bincount(y, minlength=len(languages)) / len(languages) * len(y))[y]
    k, total = len(languages), FILTERS * len(WIDTHS)
    p = {"embed": rng.normal(0, 0.5, (256, EMBEDDED)), "bias": np.zeros(total), "out": rng.normal(0, 0.1, (total, k)), "offset": np.zeros(k)}
    p |= {f"w{w}": rng.normal(0, 1 / np.sqrt(w * EMBEDDED), (w, EMBEDDED, FILTERS)) for w in WIDTHS}
    p = {name: v.astype(np.float32) for name, v in p.items()}
    m, v = ({name: np.zeros_like(a) for name, a in p.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            b, step = x[rows], step + 1
            tables = {w: np.einsum("be,wef->wbf", p["embed"], p[f"w{w}"]) for w in WIDTHS}
            pooled, where = [], []
            for w in WIDTHS:
                span = WINDOW - w + 1
                total_ = tables[w][0][b[:, :span]]
                for j in range(1, w):
                    total_ += tables[w][j][b[:, j : j + span]]
                at = total_.argmax(axis=1)
                where.append(at)
                pooled.append(np.take_along_axis(total_, at[:, None], axis=1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + p["bias"]
            h = np.maximum(raw, 0)
            z = h @ p["out"] + p["offset"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(rows)), y[rows]] -= 1
            z *= (share[rows] / len(rows))[:, None].astype(np.float32)
            dh = (z @ p["out"].T) * (raw > 0)
            grads = {"out": h.T @ z + 1e-4 * p["out"], "offset": z.sum(axis=0), "bias": dh.sum(axis=0), "embed": np.zeros_like(p["embed"])}
            for i, w in enumerate(WIDTHS):
                g = dh[:, i * FILTERS : (i + 1) * FILTERS]
                grads[f"w{w}"] = np.zeros_like(p[f"w{w}"])
                for j in range(w):
                    cell = np.take_along_axis(b, where[i] + j, axis=1).astype(np.int64) * FILTERS + np.arange(FILTERS)
                    d = np.bincount(cell.ravel(), weights=g.ravel(), minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
                    grads[f"w{w}"][j] = p["embed"].T @ d
                    grads["embed"] += d @ p[f"w{w}"][j].T
            rate = 0.01 * 0.7**epoch
            for name, g in grads.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    tables = [np.ascontiguousarray(np.einsum("be,wef->wbf", p["embed"], p[f"w{w}"]), np.float32) for w in WIDTHS]
    return ByteNetwork(languages, tables, p["bias"], p["out"], p["offset"])


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its key as text leaves 1 modulo 3. A null key is not."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE) -> ByteNetwork | None:
    """A network for all languages from at most about per_language documents of each, chosen by a hash of their keys, three windows of each; None without any label."""
    usable = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("key")))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return None
    per_language = max(1, min(per_language, LEARNED_MOST // len(counts)))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, per_language / r["count"]))])
    draw = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    size = F.length("text")
    parts = [F.substring("text", (size * i / PARTS).cast("int") + 1, F.lit(WINDOW)) for i in range(PARTS)]
    rows = usable.where(draw < share[F.col("lang")]).select(F.xxhash64("key", "text").alias("order"), "lang", *[p.alias(f"p{i}") for i, p in enumerate(parts)]).orderBy("order", "p0", "lang").limit(per_language * len(counts) * 2).collect()
    samples = [(r[f"p{i}"], r["lang"]) for r in rows for i in range(PARTS) if i == 0 or len(r["p0"]) * PARTS > WINDOW]
    return train([s for s, _ in samples], [t for _, t in samples])


def identify(docs: DataFrame, network: ByteNetwork | None, text: str = "text") -> DataFrame:
    """docs plus lang_pred and score, the network's probability of it.

    The whole text counts, in windows. A null text, or one without a letter, is und with score 0; so are all without a
    network. Repeated rows give repeated results, an empty table an empty one. Columns named like a result are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    others = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    held = fresh([*others, "lang_pred", "score"], "letters_")
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.when(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.col(f"`{text}`").cast("string")).alias(held))
    schema = source.drop(held).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part in text_slices(batches, held):
            at = part.schema.get_field_index(held)
            data, offsets = text_bytes(part.column(at))
            rows = len(offsets) - 1
            names, score = np.full(rows, "und", dtype=object), np.zeros(rows)
            if net is not None and len(data):
                windows, row, filled = windows_of(data, offsets)
                logits = net.logits(windows) * filled[:, None]
                seen = np.flatnonzero(np.diff(offsets) > 0)
                mean = np.stack([np.bincount(row, weights=logits[:, i], minlength=rows) for i in range(logits.shape[1])], axis=1)[seen] / np.diff(offsets)[seen, None]
                mean = np.exp(mean - mean.max(axis=1, keepdims=True))
                mean /= mean.sum(axis=1, keepdims=True)
                names[seen] = np.array(net.languages, dtype=object)[mean.argmax(axis=1)]
                score[seen] = mean.max(axis=1)
            columns = [part.column(i) for i in range(part.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score)], schema=pa.schema([*[part.schema.field(i) for i in range(part.num_columns) if i != at], pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]))
        tidy()

    return source.mapInArrow(run, schema)


def predicted(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Per document: key, held_out, lang_pred, score; the network learns from the labelled documents that aren't held out."""
    network = fit(docs, text, lang, key)
    return identify(docs.select(key, text), network, text).select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, that the network names a language for: those with a letter. Others have no language and go.

    The network chooses between the languages it has learned, so a document with letters is never rejected by its
    score; where nothing could be learned, documents with letters stay all the same.
    """
    network = fit(docs, text, lang, key)
    if network is None:
        return docs.where(F.coalesce(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.lit(False)))
    names = {c: fresh(docs.columns, f"{c}_kept_") for c in docs.columns if c.lower() in ("lang_pred", "score")}
    found = identify(docs.withColumnsRenamed(names), network, text).where("lang_pred <> 'und'")
    return found.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])
