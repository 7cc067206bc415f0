"""Quality classifier by co-training.

Two classifiers see different views of a document: the words and style of its text, and its page metadata. Over
rounds each scores all unlabelled documents and labels those it is surest of for the other one to learn from. Both are then
calibrated on labelled documents kept apart, and combined by a logistic regression of the two.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, NON_SPACE, Words, bounded_batches, fresh, mix64, text_bytes, text_slices, tidy

BUCKETS = 1 << 17  # hashed words of the text view
META_BUCKETS = 1 << 12
STATS = 14
LABELLED_MOST = 5000  # labelled documents that are fitted on
FIT_WORDS = 1 << 20  # words of the sample that a step of a fit takes at once
SEEN_LEAST = 4  # documents of the sample that a feature occurs in to be used
ROUNDS, SURE, ADDED_MOST = 3, 0.97, 500
METADATA = ("source", "lang")
PUNCT = np.isin(np.arange(256), list(b"!\"#$%&()*+/:;<=>?@[\\]^_{|}~"))


def text_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets and hashed distinct words of each text, as they stand between blanks and as runs of letters and digits, and its style in STATS numbers."""
    w, plain = Words(col, NON_SPACE), Words(col, ALNUM)
    rows, n = w.rows, np.maximum(1, np.diff(w.offsets)).astype(float)
    spaced = w.row.astype(np.int64) * BUCKETS + (w.hash % np.uint64(BUCKETS)).astype(np.int64)
    cell = _distinct(np.append(spaced, plain.row.astype(np.int64) * BUCKETS + (mix64(plain.hash ^ np.uint64(7)) % np.uint64(BUCKETS)).astype(np.int64)))
    raw, offsets = text_bytes(col)
    size = np.diff(offsets)
    per = lambda numbers: np.diff(np.append(0, np.cumsum(numbers, dtype=np.int64))[w.offsets]) / n
    share = lambda flags: np.diff(np.searchsorted(np.flatnonzero(flags), offsets)) / np.maximum(1, size)
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    length = w.end - w.start
    last = w.data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    stats = np.stack(
        [
            per(again), np.diff(np.searchsorted(_distinct(spaced), np.arange(rows + 1) * BUCKETS)) / n, np.log1p(n) / 5, per(length) / 10, np.sqrt(np.maximum(0, per(length**2) - per(length) ** 2)) / 10,
            per((last == 46) | (last == 63)), per((last == 44) | (last == 59) | (last == 58)), per(last == 33), share(raw - np.uint8(65) < 26), share(raw - np.uint8(48) < 10),
            share(PUNCT[raw]), share(raw >= 128), share(raw == 10) * 20, share(raw == 124) * 5,
        ],
        axis=1,
    )
    return np.searchsorted(cell, np.arange(rows + 1) * BUCKETS), cell % BUCKETS, stats


def _distinct(x: np.ndarray) -> np.ndarray:
    """As np.unique, by a sort, which is faster here than its table of hashes."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def metadata_view(frame: pd.DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and hashed metadata: each column's value, all values together and the size class of the text."""
    parts = [frame[c].astype("string").fillna("\x00") for c in columns]
    parts.append(np.log2(frame["size_"].fillna(0).astype(float) + 1).round().astype(int).astype(str))
    if len(columns) > 1:
        joined = parts[0]
        for p in parts[1:-1]:
            joined = joined + "\x01" + p
        parts.append(joined)
    hashed = [mix64(pd.util.hash_array(np.asarray(p, dtype=object), categorize=True) + np.uint64(i)) % np.uint64(META_BUCKETS) for i, p in enumerate(parts)]
    return np.arange(len(frame) + 1) * len(parts), np.stack(hashed, axis=1).ravel().astype(np.int64)


@dataclass
class Linear:
    """Logistic regression on sparse 0/1 features and dense ones."""

    weights: np.ndarray
    dense: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bias: float = 0.0

    def logits(self, offsets: np.ndarray, index: np.ndarray, stats: np.ndarray) -> np.ndarray:
        total = np.append(0.0, np.cumsum(self.weights[index]))
        return total[offsets[1:]] - total[offsets[:-1]] + np.clip((stats - self.mean) / self.scale, -5, 5) @ self.dense + self.bias


def fit_linear(offsets, index, stats, y, weight, buckets: int, steps: int = 120, rate: float = 0.05, decay: float = 3e-4) -> Linear:
    """Full-batch Adam; the classes weigh the same."""
    n = len(y)
    mean, scale = (stats.mean(axis=0), stats.std(axis=0) + 1e-6) if stats.shape[1] else (np.zeros(0), np.ones(0))
    x = np.clip((stats - mean) / scale, -5, 5)
    used = np.bincount(index, minlength=buckets) >= SEEN_LEAST
    keep, names = used[index], np.flatnonzero(used)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))[keep]
    index = (np.cumsum(used, dtype=np.int32) - 1)[index[keep]]
    del keep
    cuts = range(0, len(index), FIT_WORDS)  # parts, as a step's numbers would take several times what the words take

    def by_row(weights: np.ndarray) -> np.ndarray:
        return sum((np.bincount(row[a : a + FIT_WORDS], weights=weights[index[a : a + FIT_WORDS]], minlength=n) for a in cuts), np.zeros(n))

    def by_name(weights: np.ndarray) -> np.ndarray:
        return sum((np.bincount(index[a : a + FIT_WORDS], weights=weights[row[a : a + FIT_WORDS]], minlength=len(names)) for a in cuts), np.zeros(len(names)))

    share = weight * np.where(y == 1, 0.5 / max(1e-9, (weight * (y == 1)).sum()), 0.5 / max(1e-9, (weight * (y == 0)).sum()))
    # A feature counts by how much more often one class has it, so the many that say nothing don't drown the few that do.
    least = 2 * share.max()
    ratio = np.log((by_name(share * (y == 1)) + least) / (by_name(share * (y == 0)) + least))
    p = np.zeros(len(names) + x.shape[1] + 1)
    k, m, v = len(names), np.zeros(len(p)), np.zeros(len(p))
    for step in range(1, steps + 1):
        z = by_row(p[:k] * ratio) + x @ p[k:-1] + p[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.concatenate([ratio * by_name(g), x.T @ g, [g.sum()]]) + decay * np.append(p[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(buckets)
    weights[names] = p[:k] * ratio
    return Linear(weights, p[k:-1], mean, scale, float(p[-1]))


def logistic(features: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights and bias of a small logistic regression, by Newton's steps with a ridge."""
    x = np.column_stack([features, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


@dataclass
class CoTrained:
    text: Linear
    meta: Linear
    calibrations: list[np.ndarray]
    mix: np.ndarray
    added: list[tuple[int, int]] = field(default_factory=list)
    cut: float = 0.5  # the score from which recall and precision are best on the labels apart, recall counting twice; 0.5 at most

    def views(self, text, meta) -> np.ndarray:
        z = [self.text.logits(*text), self.meta.logits(*meta)]
        return np.stack([c[0] * np.clip(x, -30, 30) + c[1] for c, x in zip(self.calibrations, z, strict=True)], axis=1)

    def score(self, text, meta) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.views(text, meta) @ self.mix[:-1] + self.mix[-1], -30, 30)))


def _take(view, rows):
    offsets, index, stats = view
    found = [index[a:b] for a, b in zip(offsets[:-1][rows].tolist(), offsets[1:][rows].tolist(), strict=True)]
    return np.append(0, np.cumsum(np.diff(offsets)[rows])), np.concatenate([index[:0], *found]), stats[rows]


def _joined(a, b):
    return np.concatenate([a[0], a[0][-1] + b[0][1:]]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])


def _recall_cut(scores: np.ndarray, y: np.ndarray) -> float:
    best, cut = -1.0, 0.5
    for c in [0.5, *np.unique(scores[(y == 1) & (scores < 0.5)])[::-1]]:
        said, right = (scores >= c).sum(), ((scores >= c) & (y == 1)).sum()
        f = 5 * right / max(1, said + 4 * (y == 1).sum())
        if f > best:
            best, cut = f, float(c)
    return cut


def rounds(text, meta, y: np.ndarray, apart: np.ndarray) -> Generator:
    """Learns in rounds: yields the turn, both models and their calibrations, and is sent, for each view, what it is surest of: the other view's features and the labels."""
    labelled, held = np.flatnonzero((y >= 0) & ~apart), np.flatnonzero((y >= 0) & apart)
    views, buckets = (text, meta), (BUCKETS, META_BUCKETS)
    told, added = [None, None], []
    for turn in range(ROUNDS + 1):
        models, cal = [], []
        for view, new, size in zip(views, told, buckets, strict=True):
            rows, target, weight = _take(view, labelled), y[labelled], np.ones(len(labelled))
            if new is not None and len(new[1]):
                rows, target, weight = _joined(rows, new[0]), np.concatenate([target, new[1]]), np.concatenate([weight, np.full(len(new[1]), 0.5)])
            models.append(fit_linear(*rows, target, weight, size))
            cal.append(logistic(np.clip(models[-1].logits(*_take(view, held)), -30, 30)[:, None], y[held].astype(float)) if len(held) else np.array([1.0, 0.0]))
        if turn < ROUNDS:
            sure = yield turn, models, cal
            told = [sure[1], sure[0]]
            added.append(tuple(0 if x is None else len(x[1]) for x in sure))
    out = CoTrained(models[0], models[1], cal, np.array([1.0, 0.0, 0.0]), added)
    if len(held):
        known = _take(text, held), _take(meta, held)
        out.mix = logistic(out.views(*known), y[held].astype(float))
        out.cut = _recall_cut(out.score(*known), y[held])
    return out


def cotrain(text, meta, y: np.ndarray, apart: np.ndarray) -> CoTrained:
    """y: 1, 0 or -1 for unlabelled; apart: labelled rows for calibration alone."""
    pool, views = np.flatnonzero(y < 0), (text, meta)
    learner = rounds(text, meta, y, apart)
    state = next(learner)
    while True:
        turn, models, cal = state
        found = []
        for i in (0, 1):
            z = _certain(models[i], cal[i], _take(views[i], pool))
            sure = np.flatnonzero(np.abs(z) >= np.log(SURE / (1 - SURE)))
            sure = sure[np.argsort(-np.abs(z[sure]), kind="stable")][: ADDED_MOST * (turn + 1)]
            found.append((_take(views[1 - i], pool[sure]), (z[sure] > 0).astype(int)))
        try:
            state = learner.send(found)
        except StopIteration as end:
            return end.value


def _certain(model: Linear, cal: np.ndarray, view) -> np.ndarray:
    return cal[0] * np.clip(model.logits(*view), -30, 30) + cal[1]


def _described(part: pa.RecordBatch) -> pa.RecordBatch:
    """A slice with its text's words, style and size instead of the text. Words and style are bytes, as lists of numbers take ten times the driver's memory."""
    at = part.schema.get_field_index("text")
    offsets, index, stats = text_view(part.column(at))
    index = index.astype(np.int32)
    words = pa.array([index[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
    size = pa.compute.fill_null(pa.compute.binary_length(part.column(at)), 0).cast(pa.int64())
    rest = [(n, part.column(i)) for i, n in enumerate(part.schema.names) if i != at]
    return pa.RecordBatch.from_arrays([*(c for _, c in rest), words, pa.array([x.tobytes() for x in stats], pa.binary()), size], names=[*(n for n, _ in rest), "words", "stats", "size_"])


def _sample(docs: DataFrame, labels: DataFrame, targets: list[str], metadata: list[str], text: str, key: str) -> tuple[pd.DataFrame | None, DataFrame]:
    """Features of a bounded sample of labelled documents, chosen by a hash of their keys; and the other documents."""
    spark = docs.sparkSession
    order = F.xxhash64(F.col("key").cast("string"), F.lit(3))
    known = labels.select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{t}`").cast("int").alias(f"y{i}") for i, t in enumerate(targets)]).where(F.col("key").isNotNull() & F.col("y0").isNotNull()).orderBy(order, *[f"y{i}" for i in range(len(targets))]).limit(LABELLED_MOST)
    known = spark.createDataFrame(known.collect(), known.schema).dropDuplicates(["key"])
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), *[F.col(f"`{m}`").cast("string").alias(f"m{i}") for i, m in enumerate(metadata)])
    rows = source.join(F.broadcast(known), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            yield _described(part)

    ys = [f"y{i}" for i in range(len(targets))]
    ms = [f"m{i}" for i in range(len(metadata))]
    columns = ["key", "text", *ms, *ys]
    schema = f"key {source.schema['key'].dataType.simpleString()}, {''.join(f'{m} string, ' for m in ms)}{''.join(f'{y} int, ' for y in ys)}words binary, stats binary, size_ bigint"
    found = rows.select(*columns).mapInArrow(run, schema).withColumn("apart", F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(11)), F.lit(5)) == 0).withColumn("o", F.xxhash64("key", "size_", "words")).orderBy("o").limit(2 * LABELLED_MOST).collect()
    frame = pd.DataFrame([r.asDict() for r in found])
    return frame if len(frame) and frame["y0"].notna().any() else None, source.join(F.broadcast(known.select("key")), "key", "left_anti").drop("key")


def _features(frame: pd.DataFrame, metadata: list[str]):
    """Both views of rows of words, stats, metadata and size."""
    ends = np.cumsum([len(x) // 4 for x in frame["words"]])
    stats = np.frombuffer(b"".join(frame["stats"]), np.float64).reshape(len(frame), STATS)
    words = np.append(0, ends).astype(np.int64), np.frombuffer(b"".join(frame["words"]), np.int32), stats
    return words, (*metadata_view(frame, metadata), np.zeros((len(frame), 0)))


def _top(z: np.ndarray, o: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest z and their o, of an o that repeats the largest alone."""
    at = np.lexsort((o, -z))
    at = at[np.sort(np.unique(o[at], return_index=True)[1])[:most]]
    return z[at], o[at]


def _surest(others: DataFrame, states: dict[str, tuple], ms: list[str], most: int) -> dict[str, list]:
    """For each target and view, of all other documents the most that the view is surest of, half of each class: the other view's features and the labels.

    All documents are scored, but only a hash and a score of the surest of each task move; features are made again for those that were chosen of all.
    """
    spark = others.sparkSession
    groups = [(t, v, c) for t in states for v in (0, 1) for c in (0, 1)]
    shared = spark.sparkContext.broadcast({t: (models, cal) for t, (_, models, cal) in states.items()})
    least, half = np.log(SURE / (1 - SURE)), most // 2
    named = others.withColumn("o", F.xxhash64("text", *ms, *[F.col(c).isNull() for c in ("text", *ms)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in groups]
        for part in text_slices(batches, "text"):
            col = part.column(part.schema.get_field_index("text"))
            frame = pd.DataFrame({m: part.column(part.schema.get_field_index(m)).to_pylist() for m in ms}, index=range(part.num_rows))
            frame["size_"] = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
            views = text_view(col), (*metadata_view(frame, ms), np.zeros((part.num_rows, 0)))
            order = part.column(part.schema.get_field_index("o")).to_numpy()
            scores = {(t, v): _certain(shared.value[t][0][v], shared.value[t][1][v], views[v]) for t in states for v in (0, 1)}
            for g, (t, v, c) in enumerate(groups):
                z = scores[t, v] if c else -scores[t, v]
                sure = np.flatnonzero(z >= least)
                best[g] = _top(np.append(best[g][0], z[sure]), np.append(best[g][1], order[sure]), half)
        for g, (z, o) in enumerate(best):
            if len(o):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(o), g), pa.int32()), pa.array(o), pa.array(z)], names=["g", "o", "z"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in text_slices(batches, "text"):
            new = [o not in seen and not seen.add(o) for o in part.column(part.schema.get_field_index("o")).to_pylist()]
            if any(new):
                yield _described(part.filter(pa.array(new)))

    near = named.mapInArrow(run, "g int, o bigint, z double").groupBy("g", "o").agg(F.max("z").alias("z"))
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("z"), "o"))
    chosen = near.withColumn("place", place).where(F.col("place") <= half).orderBy("g", "place").collect()
    wanted = F.broadcast(spark.createDataFrame([(o,) for o in sorted({r["o"] for r in chosen})], "o bigint"))
    schema = "".join(f"{m} string, " for m in ms) + "o bigint, words binary, stats binary, size_ bigint"
    rows = named.select("text", *ms, "o").join(wanted, "o", "left_semi").select("text", *ms, "o").mapInArrow(describe, schema).dropDuplicates(["o"]).collect() if chosen else []
    known = {r["o"]: r.asDict() for r in rows}
    out: dict[str, list] = {t: [None, None] for t in states}
    for t in states:
        for v in (0, 1):
            found = [(known[r["o"]], groups[r["g"]][2]) for r in chosen if groups[r["g"]][:2] == (t, v)]
            if found:
                out[t][v] = _features(pd.DataFrame([x for x, _ in found]), ms)[1 - v], np.array([c for _, c in found])
    shared.destroy()
    return out


def fit(docs: DataFrame, labels: DataFrame, targets: list[str], metadata: list[str], text: str = "text", key: str = "doc_id") -> dict[str, CoTrained]:
    """A model for each 0/1 column of labels that has both values in the sample."""
    bounded_batches(docs.sparkSession)
    frame, others = _sample(docs, labels, targets, metadata, text, key)
    models: dict[str, CoTrained] = {}
    if frame is None:
        return models
    ms = [f"m{i}" for i in range(len(metadata))]
    words, meta = _features(frame, ms)
    frame = frame.drop(columns=["words", "stats"])
    learners = {}
    for i, target in enumerate(targets):
        y = frame[f"y{i}"].fillna(-1).to_numpy().astype(int)
        train = y[(y >= 0) & ~frame["apart"].to_numpy(bool)]
        if {0, 1} <= set(train.tolist()):
            learners[target] = rounds(words, meta, y, frame["apart"].to_numpy(bool))
    states = {t: next(x) for t, x in learners.items()}
    for turn in range(ROUNDS if states else 0):
        found = _surest(others, states, ms, ADDED_MOST * (turn + 1))
        for t, x in learners.items():
            try:
                states[t] = x.send(found[t])
            except StopIteration as end:
                models[t] = end.value
        tidy()
    return models


def score_documents(docs: DataFrame, models: dict[str, CoTrained], targets: list[str], metadata: list[str], text: str = "text") -> DataFrame:
    """docs without its text, plus <target>_score of each target (null without a model). One pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    results = [f"{t}_score" for t in targets]
    others = [c for c in docs.columns if c != text and c.lower() not in results]
    held = fresh([*others, *results], "text_")
    metas = [fresh([*others, *results, held], f"meta_{i}_") for i in range(len(metadata))]
    source = docs.select(*[F.col(f"`{c}`") for c in others], *[F.col(f"`{m}`").cast("string").alias(n) for m, n in zip(metadata, metas, strict=True)], F.col(f"`{text}`").cast("string").alias(held))
    kept = source.select(*[F.col(f"`{c}`") for c in others])
    schema = kept.select("*", *[F.lit(0.0).cast("double").alias(r) for r in results]).schema
    for r in results:
        schema[r].nullable = True
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, held):
            names = part.schema.names
            col = part.column(names.index(held))
            words = text_view(col)
            frame = pd.DataFrame({f"m{i}": part.column(names.index(n)).to_pylist() for i, n in enumerate(metas)}, index=range(part.num_rows))
            frame["size_"] = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
            meta = (*metadata_view(frame, [f"m{i}" for i in range(len(metas))]), np.zeros((part.num_rows, 0)))
            scores = [pa.array(shared.value[t].score(words, meta)) if t in shared.value else pa.nulls(part.num_rows, pa.float64()) for t in targets]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i, n in enumerate(names) if n in others), *scores], names=[*(n for n in names if n in others), *results])

    return source.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", metadata: tuple[str, ...] = METADATA) -> DataFrame:
    """Per document: key, quality_score, toxic_score, keep (quality at least one half and toxicity below the model's cut).

    All documents are scored, whole; the models are fitted on LABELLED_MOST labelled documents at most, and in each round
    on those of all others that they are surest of, ADDED_MOST times the round a view. Null texts and metadata count as empty values; without usable labels a score is null and doesn't speak against keeping.
    Repeated rows give repeated results, an empty table an empty one; other columns don't matter.
    """
    targets = ["quality", "toxic"]
    present = [m for m in metadata if m in docs.columns]
    models = fit(docs, labels, targets, present, text, key)
    scored = score_documents(docs.select(key, text, *present), models, targets, present, text)
    keep = (F.coalesce(F.col("quality_score"), F.lit(1.0)) >= 0.5) & (F.coalesce(F.col("toxic_score"), F.lit(0.0)) < (models["toxic"].cut if "toxic" in models else 0.5))
    return scored.select(key, "quality_score", "toxic_score", keep.alias("keep"))
