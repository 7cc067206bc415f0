"""Shared plumbing: scratch tables, Arrow slices and word arrays."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19  # text bytes that a Python worker turns into arrays at once
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one only where that is unset and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="dqloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/dqloom-{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again.

    The written table cuts the lineage, so lost executors cost no recomputation
    beyond the stage that reads it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again, as all that was made from them is written itself."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.split("/")[-2].startswith("dqloom-"):
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Frees the driver's garbage, so Spark drops the shuffle files of tables that have been written since."""
    gc.collect()
    spark._jvm.System.gc()


def tidy() -> None:
    """Gives freed memory of a Python worker back at a task's end, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def bounded_batches(spark: SparkSession, megabytes: int = 4) -> None:
    """Arrow batches end at so many bytes, where Spark knows the setting, and readers take fewer rows at once, so long texts don't pile up.

    Both are settings of the session, and stay.
    """
    spark.conf.set(BATCH_BYTES, str(megabytes << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1024")


def fresh(names: list[str], wanted: str) -> str:
    """A column name that none of names has, so extra input columns never clash."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut so that a slice has about limit bytes of text (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column as uint8, and the row offsets (rows + 1); null counts as empty."""
    col = pa.compute.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so its powers have inverses modulo 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_powers.up):
        size = max(n, SLICE_BYTES + (1 << 17), len(_powers.up) + (1 << 18))
        with np.errstate(over="ignore"):
            one = np.ones(1, np.uint64)
            _powers.up = np.cumprod(np.append(one, np.full(size - 1, _BASE, np.uint64)), dtype=np.uint64)
            _powers.down = np.cumprod(np.append(one, np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)), dtype=np.uint64)
    return _powers.up, _powers.down


_powers.up = _powers.down = np.zeros(0, np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its end, wherever they stand."""
    n = len(data)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _MULT)


def word_class(allowed) -> np.ndarray:
    """256 flags: which bytes, once lower-cased, belong to a word."""
    flags = np.zeros(256, dtype=bool)
    for b in range(256):
        flags[b] = allowed(b)
    return flags


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of a slice of texts as arrays: start and end byte, row and 64-bit hash of each, and rows' offsets."""

    def __init__(self, col: pa.Array, flags: np.ndarray):
        raw, offsets = text_bytes(col)
        self.data = LOWER[raw]
        n = len(self.data)
        inside = flags[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        starts_of_rows = offsets[1:-1][offsets[1:-1] < n]
        begins[starts_of_rows] = inside[starts_of_rows]
        self.start = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        last = starts_of_rows[starts_of_rows > 0] - 1
        ends[last] = inside[last]
        self.end = np.flatnonzero(ends) + 1
        self.rows = len(offsets) - 1
        self.offsets = np.searchsorted(self.start, offsets)  # first word of each row
        self.row = np.repeat(np.arange(self.rows), np.diff(self.offsets))
        self.hash = span_hashes(self.data, self.start, self.end)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all lie in its row."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        if n < k:
            return out, np.zeros(n, bool)
        m = n - k + 1
        with np.errstate(over="ignore"):
            for j in range(k):
                out[:m] = (out[:m] + self.hash[j : j + m]) * _MULT
        fits = np.zeros(n, bool)
        fits[:m] = self.row[:m] == self.row[k - 1 :]
        return mix64(out), fits


#: Words of digits, lower-cased letters and everything that isn't ASCII.
ALNUM = word_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Words between ASCII white space.
NON_SPACE = word_class(lambda b: b not in (9, 10, 11, 12, 13, 32))


def lower_ascii(col):
    """A-Z in lower case, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Rows (a key and a mark, some 50 bytes) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def keep_rows(docs: DataFrame, key: str, mark, judged: DataFrame) -> DataFrame:
    """The rows of docs that stay by judged: k, m (key and mark), stays and n (rows). All columns of docs, and no others.

    Rows that repeat a key and a mark come once. Where none do and the rows that go are few enough to be broadcast, the
    documents aren't shuffled at all; else they are, once.
    """
    names = list(docs.columns)
    for wanted in ("mark_", "k_", "m_"):
        names.append(fresh(names, wanted))
    at, k, m = names[-3:]
    pairs = judged.groupBy(F.col("k").alias(k), F.col("m").alias(m)).agg(F.max("stays").alias("stays"), F.sum("n").alias("n"))
    pairs = written(pairs, "judged")
    gone, repeated = pairs.agg(F.count_if(~F.col("stays")), F.count_if(F.col("stays") & (F.col("n") > 1))).first()
    marked = docs.withColumn(at, mark)
    same = F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.col(at) == F.col(m))
    if not repeated and gone <= BROADCAST_ROWS:
        found = marked.join(F.broadcast(pairs.where("not stays").select(k, m)), same, "left_anti")
    else:
        found = marked.join(pairs.where("stays").select(k, m), same, "left_semi").dropDuplicates([key, at])
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
