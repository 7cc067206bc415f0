"""Tables: full, bounded and delta scans, guarded SQL, probes and JDBC with retries."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import to_time

T = TypeVar("T")
#: Marks of errors that a later attempt may not meet.
TRANSIENT = ("08s01", "08001", "10053", "10054", "10060", "communication link failure", "connection reset", "connection was closed", "deadlock", "login timeout", "query timeout", "server is not available", "timed out", "tcp provider")
TEXT_LIMIT = 4000


def project(df: DataFrame, columns: list[str] | None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def scan(df: DataFrame, columns: list[str] | None = None, created: str | None = None, since: datetime | str | None = None) -> DataFrame:
    """The columns of a table, bounded below by since (inclusive) if given. Both reach the file scan."""
    out = df.where(F.col(f"`{created}`") >= F.lit(since).cast("timestamp")) if created and since is not None else df
    return project(out, columns)


def scan_delta(df: DataFrame, created: str, since: datetime | str | None, columns: list[str] | None = None) -> DataFrame:
    """Rows created strictly after since (all without it). A late row of exactly that instant is not read again."""
    out = df.where(F.col(f"`{created}`") > F.lit(since).cast("timestamp")) if since is not None else df
    return project(out, columns)


def guarded_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A query by the user; anything but SELECT or WITH is refused, and so are several statements."""
    text = re.sub(r"/\*.*?\*/|--[^\n]*", " ", sql, flags=re.DOTALL).strip().rstrip(";").strip()
    if not re.match(r"(?i)(select|with)\b", text) or ";" in re.sub(r"'[^']*'", "", text):
        raise ValueError("only one SELECT or WITH query is allowed")
    bare = re.sub(r"\{(\w+)\}", r"\1", text)  # names of the given tables
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(bare).getClass().getSimpleName()
    if "Insert" in plan or "Command" in plan or "Create" in plan:
        raise ValueError("only queries are allowed")
    return spark.sql(text, **tables)


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def long_text_columns(types: dict[str, str]) -> list[str]:
    """Columns of unbounded text by the database's type names."""
    return [c for c, t in types.items() if re.search(r"(?i)\bn?text\b|n?varchar\s*\(\s*max\s*\)", t)]


def select_clause(columns: list[str], long_text: list[str], cast: bool = True, limit: int = TEXT_LIMIT) -> str:
    """The column list of a database query; unbounded text is read as bounded, which drivers fetch in blocks."""
    item = lambda c: f"CAST([{c}] AS NVARCHAR({limit})) AS [{c}]" if cast and c in long_text else f"[{c}]"
    return ", ".join(map(item, columns))


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], types: dict[str, str] | None = None, created: str | None = None, since: datetime | None = None, strict: bool = False, fetch: int = 50_000, split: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A table by JDBC, read in chunks of fetch rows; split (column, low, high, parts) reads parts side by side."""
    where = f" WHERE [{created}] {'>' if strict else '>='} '{since:%Y-%m-%dT%H:%M:%S.%f}'" if created and since else ""
    query = f"(SELECT {select_clause(columns, long_text_columns(types or {}))} FROM {table}{where}) q"
    reader = spark.read.format("jdbc").options(url=url, dbtable=query, fetchsize=str(fetch), **options)
    if split:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def is_transient(error: BaseException) -> bool:
    return any(mark in str(error).lower() for mark in TRANSIENT)


def with_retries(action: Callable[[], T], retries: int = 3, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """action's result; a transient error starts it anew after wait, 2 * wait, ... seconds, any other is raised at once."""
    for attempt in range(1, retries + 2):
        try:
            return action()
        except Exception as error:
            if attempt > retries or not is_transient(error):
                raise
            sleep(wait * attempt)
    raise AssertionError


def max_created(df: DataFrame, created: str) -> datetime | None:
    """The latest readable creation time; null without any."""
    return df.agg(F.max(to_time(df, created)).alias("m")).first()["m"] if created in df.columns else None


def probe(df: DataFrame, created: str) -> DataFrame:
    """One row: rows, first and last creation time."""
    return df.agg(F.count("*").alias("n_rows"), F.min(created).alias("min_created"), F.max(created).alias("max_created"))


def probe_by_year(df: DataFrame, created: str) -> DataFrame:
    return df.where(F.col(created).isNotNull()).groupBy(F.year(created).alias("year")).agg(F.count("*").alias("n_rows")).orderBy("year")


def column_usage(df: DataFrame, required: list[str]) -> dict[str, list[str]]:
    """The table's columns that are read and those that aren't."""
    wanted = {c.lower() for c in required}
    return {"used": [c for c in df.columns if c.lower() in wanted], "unused": [c for c in df.columns if c.lower() not in wanted]}
