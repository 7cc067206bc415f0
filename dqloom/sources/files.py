"""Files whose cells are all text: CSV in any usual encoding and separator, and workbooks if a reader is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")
SEPARATORS = (";", ",", "\t")
SNIFFED = 64 << 10  # bytes in which the header line must end
CHUNK = 1 << 20
_defined = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
CONTROLS = ("".join(map(chr, _defined)), bytes(_defined).decode("cp1252"))


class EmptySource(ValueError):
    """A file that isn't there or has no rows."""


def encoding_of(spark: SparkSession, path: str) -> str:
    """The first of ENCODINGS that all bytes of the files under path agree with. Executors read the files in chunks; one byte outside UTF-8 anywhere counts."""

    def run(batches):
        import codecs

        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0):
                worst, data = 0, content.as_buffer()
                decoders = [codecs.getincrementaldecoder(e)() for e in ("utf-8", "cp1252")]
                view = memoryview(data)
                while worst < len(decoders):
                    try:
                        for at in range(0, max(1, len(view)), CHUNK):
                            decoders[worst].decode(bytes(view[at : at + CHUNK]), at + CHUNK >= len(view))
                        break
                    except UnicodeDecodeError:
                        worst += 1
                yield pa.RecordBatch.from_arrays([pa.array([worst], pa.int32())], names=["worst"])

    worst = spark.read.format("binaryFile").load(path).where("length > 0").select("content").mapInArrow(run, "worst int").agg(F.max("worst")).first()[0]
    return ENCODINGS[worst or 0]


def head_of(spark: SparkSession, path: str) -> bytes:
    """The first bytes of a file or of the first file of a folder, through Spark, so any store it reads will do."""
    rows = spark.read.format("binaryFile").load(path).select("path", "length").orderBy("path").where("length > 0").limit(1).collect()
    if not rows:
        return b""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(rows[0]["path"])
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, SNIFFED)))
    finally:
        stream.close()


def sniff(head: bytes, separator: str | None = None, encoding: str | None = None) -> tuple[str, str, list[str]]:
    """Encoding (where not given, by the head alone), separator and header. A cut last character doesn't count against UTF-8."""
    for encoding in [encoding] if encoding else ENCODINGS:
        try:
            text = head[: head.rfind(b"\n") + 1 or len(head)].decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    line = text.lstrip("﻿").split("\n", 1)[0].rstrip("\r")
    candidates = [separator, *SEPARATORS] if separator else SEPARATORS
    best = next((s for s in candidates if len(line.split(s)) > 1), candidates[0])
    return encoding, best, [c.strip().strip('"') for c in line.split(best)]


def read_csv(spark: SparkSession, path: str, separator: str | None = None, many_lines: bool = True) -> DataFrame:
    """All columns as text; an empty cell is empty text, never null. A file whose cells have no line breaks can be split (many_lines=False)."""
    head = head_of(spark, path)
    if not head.strip():
        raise EmptySource(f"no rows in {path}")
    encoding, sep, header = sniff(head, separator, encoding_of(spark, path))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    charset = "UTF-8" if encoding == "utf-8-sig" else "ISO-8859-1"
    df = spark.read.csv(path, schema=schema, header=True, enforceSchema=True, sep=sep, encoding=charset, quote='"', escape='"', multiLine=many_lines, emptyValue="", nullValue="\u0000", mode="PERMISSIVE").fillna("")
    if encoding == "cp1252":  # what Latin-1 reads as control characters are its quotes, dashes and signs
        df = df.select(*[F.translate(F.col(f"`{c}`"), *CONTROLS).alias(c) for c in df.columns])
    return df


def read_workbook(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A sheet with all cells as text. It needs pandas with an installed workbook reader."""
    import pandas as pd

    frame = pd.read_excel(path, sheet_name=sheet, dtype=str, keep_default_na=False)
    schema = T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns])
    return spark.createDataFrame(frame.astype(str).values.tolist(), schema)


def read_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """By suffix: .csv, .tsv and .txt, .xlsx and .xls, .json; anything else as Parquet. An empty file is an error."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix in ("csv", "tsv", "txt"):
        df = read_csv(spark, path, options.get("separator", "\t" if suffix == "tsv" else None))
    elif suffix in ("xlsx", "xls"):
        df = read_workbook(spark, path, options.get("sheet", 0))
    elif suffix == "json":
        df = spark.read.json(path)
    else:
        df = spark.read.parquet(path)
    if df.isEmpty():
        raise EmptySource(f"no rows in {path}")
    return df


def optional_table(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A table that may be absent: then an empty one of the schema."""
    if not path:
        return spark.createDataFrame([], schema)
    try:
        return read_file(spark, path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or isinstance(error, (EmptySource, FileNotFoundError)):
            return spark.createDataFrame([], schema)
        raise
