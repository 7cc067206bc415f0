"""Outputs: tables in folders swapped in whole, CSV for spreadsheets, capped anomaly sheets, extractions, notices."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHEET_ROWS = 1_048_575
ANOMALY_ROWS = 200_000
log = logging.getLogger("dqloom")


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def swap_in(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write beside path, then take its place; df may read the old table.

    The old table is renamed aside before the new one is renamed in, and deleted last, so a crash at any point leaves one of them
    whole: recover() puts an old one back whose place is empty. Between the two renames readers find nothing.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    stage, aside = (f"{path.rstrip('/')}.{kind}-{mark}" for kind in ("stage", "old"))
    write(df, stage)
    fs, place = _fs(spark, path)
    fs.mkdirs(place.getParent())
    moved = fs.exists(place)
    if moved and not fs.rename(place, _fs(spark, aside)[1]):
        raise OSError(f"{path} couldn't be renamed")
    if not fs.rename(_fs(spark, stage)[1], place):
        if moved:
            fs.rename(_fs(spark, aside)[1], place)
        raise OSError(f"{stage} couldn't be renamed to {path}")
    if moved:
        fs.delete(_fs(spark, aside)[1], True)


def recover(spark: SparkSession, path: str) -> bool:
    """Whether a table that a crash left aside was put back in its empty place."""
    fs, place = _fs(spark, path)
    if fs.exists(place):
        return False
    left = fs.globStatus(_fs(spark, f"{path.rstrip('/')}.old-*")[1]) or []
    return bool(left) and fs.rename(max(left, key=lambda x: x.getModificationTime()).getPath(), place)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table, one left aside by a crash included."""
    recover(spark, path)
    fs, place = _fs(spark, path)
    return fs.exists(place)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text in one file."""
    fs, place = _fs(spark, path)
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_table(df: DataFrame, path: str) -> None:
    swap_in(df, path, lambda d, p: d.write.parquet(p))


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """Semicolons, header, and a byte order mark before the first column's name, as spreadsheets expect."""
    first = df.columns[0]
    shown = df.withColumnRenamed(first, "﻿" + first)
    target = path if path.endswith(".csv") else path.rsplit(".", 1)[0] + ".csv" if "." in path.rsplit("/", 1)[-1] else path + ".csv"
    swap_in(shown, target, lambda d, p: (d.coalesce(1) if single else d).write.csv(p, sep=";", header=True, emptyValue="", quote='"', escape='"'))


def split_sheets(df: DataFrame, name: str, order: list[str], rows: int = SHEET_ROWS) -> dict[str, DataFrame]:
    """Sheets of at most rows rows in order: name, name_2, ... One sort; row numbers come from the sorted partitions' sizes."""
    count = df.count()
    if count <= rows:
        return {name: df}
    ordered = df.orderBy(*order).withColumns({"part_": F.spark_partition_id(), "at_": F.monotonically_increasing_id()}).persist()
    sizes = sorted((r["part_"], r["count"]) for r in ordered.groupBy("part_").count().collect())
    before, bases = 0, []
    for part, size in sizes:
        bases.append((part, before))
        before += size
    base = F.broadcast(df.sparkSession.createDataFrame(bases, "part_ int, base_ bigint"))
    numbered = ordered.join(base, "part_").withColumn("row_", F.col("base_") + F.col("at_") % F.lit(1 << 33)).drop("part_", "at_", "base_")
    return {name if i == 0 else f"{name}_{i + 1}": numbered.where((F.col("row_") >= i * rows) & (F.col("row_") < (i + 1) * rows)).drop("row_") for i in range(-(-count // rows))}


def cap_anomalies(anomalies: DataFrame, order: list[str], cap: int = ANOMALY_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """The sheet's rows, and the full table to write beside it if that has more than cap rows (0: no cap)."""
    if not cap or anomalies.limit(cap + 1).count() <= cap:
        return anomalies, None
    return anomalies.orderBy(*order).limit(cap), anomalies


def write_workbook(sheets: dict[str, DataFrame], path: str) -> list[str]:
    """One folder per sheet under path, each swapped in whole."""
    for name, df in sheets.items():
        write_table(df, f"{path.rstrip('/')}/{name}")
    return list(sheets)


def extraction_frame(df: DataFrame, source: list[str], fields: dict[str, str]) -> DataFrame:
    """The source's columns, each field's result right after its raw column, other results last, intermediates gone."""
    outs = [o for o in fields.values() if o in df.columns]
    order: list[str] = []
    for c in source:
        if c in df.columns and not c.startswith("_"):
            order += [c, *(o for raw, o in fields.items() if raw == c and o in outs)]
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*order, *outs])])


def output_dir(base: str | None, api_id: str, local: str, from_file: bool) -> str:
    """Runs over files always stay local."""
    return f"{base.rstrip('/')}/{api_id}" if base and not from_file else local


@dataclass
class Outlets:
    """Where results go besides tables. Failures here are logged and never fail a run."""

    publish: Callable[[str], None] = lambda path: None
    notify: Callable[[dict], None] = lambda message: log.info("%s", message)
    largest_attachment: int = 20 << 20
    sent: list = field(default_factory=list)

    def deliver(self, path: str) -> bool:
        try:
            self.publish(path)
            return True
        except Exception:
            log.exception("publishing failed: %s", path)
            return False

    def tell(self, status: str, counters: dict | None = None, error: BaseException | None = None, attachments: list[tuple[str, int]] = ()) -> None:
        """An OK notice has the counters, a KO notice only the kind of error."""
        message = {"status": status, "counters": counters or {}, "error": error_kind(error) if error else None, "attachments": [n for n, size in attachments if size <= self.largest_attachment]}
        try:
            self.notify(message)
            self.sent.append(message)
        except Exception:
            log.exception("the notice wasn't sent")


def error_kind(error: BaseException) -> str:
    text = f"{type(error).__name__} {error}".lower()
    for kind, marks in {"configuration": ("configerror", "config"), "source": ("jdbc", "sqlexception", "path_not_found", "emptysource", "connection"), "memory": ("outofmemory",)}.items():
        if any(m in text for m in marks):
            return kind
    return "processing"


def set_up_logging(path: str | None = None, level: int = logging.INFO) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if path:
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    logging.basicConfig(level=level, format="%(asctime)s %(levelname)s %(name)s %(message)s", handlers=handlers, force=True)
