"""First-match-wins resolution of distinct values.

A cascade is a list of steps over key columns of a table of distinct values. Table steps look a key up, rule
steps test a condition; each gives (value, method), and the first that matches counts. Rows get
the result by an equi-join on the raw value, so the steps' cost follows the distinct values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OUTLIER = "OUTLIER"
#: Rows of a dictionary that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Table:
    """Look key up in a table with columns k and v, k unique."""

    method: str
    table: DataFrame
    key: Column


@dataclass(frozen=True)
class Rule:
    """Where condition holds, the result is value; a null value leaves the row unresolved for good."""

    method: str | None
    condition: Column
    value: Column | str | None = OUTLIER


def pairs(spark: SparkSession, entries: dict[str, str] | list[tuple[str, str]], key: Callable[[Column], Column] | None = None, last_wins: bool = False) -> DataFrame:
    """Table k, v of entries; of keys made equal by key() the first (or last) in order stays."""
    rows = list(entries.items()) if isinstance(entries, dict) else list(entries)
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "i int, k string, v string")
    out = first_per_key(df.withColumn("k", key(F.col("k")) if key else F.col("k")), last_wins)
    out.rows_at_most = len(rows)
    return out


def first_per_key(df: DataFrame, last_wins: bool = False) -> DataFrame:
    """k, v of a table i, k, v: of each key the entry with the lowest (or highest) i; empty keys and null values go."""
    pick = F.max_by if last_wins else F.min_by
    return df.where(F.col("k").isNotNull() & (F.col("k") != "") & F.col("v").isNotNull()).groupBy("k").agg(pick("v", "i").alias("v"))


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, marked for broadcast if it has few enough rows (counted where the number isn't known)."""
    rows = rows if rows is not None else df.limit(BROADCAST_ROWS + 1).count()
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def cut(df: DataFrame) -> DataFrame:
    """df with its plan cut at a checkpoint in the shared folder, where one is set; else kept by the session."""
    if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return df.checkpoint()
    return df.persist()


def resolve(values: DataFrame, steps: list[Table | Rule], otherwise: str | None = OUTLIER) -> DataFrame:
    """values plus value and method. What no step matches gets otherwise as both (null: stays unresolved)."""
    out, found = values, []
    for n, step in enumerate(steps):
        if isinstance(step, Table):
            name = f"v{n}_"
            keyed = step.table.select(F.col("k").alias(f"k{n}_"), F.col("v").alias(name))
            out = out.withColumn(f"q{n}_", step.key).join(small(keyed, getattr(step.table, "rows_at_most", None)), F.col(f"q{n}_") == F.col(f"k{n}_"), "left")
            found.append(F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("value"), F.lit(step.method).alias("method"))))
        else:
            value = step.value if isinstance(step.value, Column) else F.lit(step.value).cast("string")
            found.append(F.when(F.coalesce(step.condition, F.lit(False)), F.struct(value.alias("value"), F.lit(step.method).cast("string").alias("method"))))
    last = F.struct(F.lit(otherwise).cast("string").alias("value"), F.lit(otherwise).cast("string").alias("method"))
    out = out.withColumn("found_", F.coalesce(*found, last))
    return out.select(*[F.col(f"`{c}`") for c in values.columns], F.col("found_.value").alias("value"), F.col("found_.method").alias("method"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct combinations in which the first column isn't null."""
    return df.select(*[F.col(f"`{c}`") for c in columns]).where(F.col(f"`{columns[0]}`").isNotNull()).distinct()


def attach(df: DataFrame, resolved: DataFrame, on: list[str], value: str, method: str, extra: dict[str, str] | None = None) -> DataFrame:
    """df plus the resolved value and method of its raw values (null where there is none)."""
    table = resolved.select(*[F.col(f"`{c}`").alias(f"raw{i}_") for i, c in enumerate(on)], F.col("value").alias(value), F.col("method").alias(method), *[F.col(k).alias(v) for k, v in (extra or {}).items()])
    match = None
    for i, c in enumerate(on):
        # Further keys may be null on both sides; the first one never is.
        one = df[c] == F.col(f"raw{i}_") if i == 0 else df[c].eqNullSafe(F.col(f"raw{i}_"))
        match = one if match is None else match & one
    table = table.persist()  # counted for the choice of the join, then joined
    return df.join(small(table), match, "left").drop(*[f"raw{i}_" for i in range(len(on))])


def target_index(spark: SparkSession, entries: dict[str, str], key: Callable[[Column], Column]) -> DataFrame:
    """Table from a dictionary's cleaned target values to themselves: a value that is a target already resolves to it."""
    return pairs(spark, [(v, v) for v in entries.values() if v and v != OUTLIER], key)


def memory_steps(memory: DataFrame, forms: list[Column], upper: bool = False) -> list[Table]:
    """WARM steps: the memory (k, v) by each form of the raw value in turn, then, if upper, by upper-case keys."""
    steps = [Table("WARM", memory, f) for f in forms]
    if upper:
        folded = memory.select(F.upper(F.trim("k")).alias("k"), "v", F.col("k").alias("i"))
        steps.append(Table("WARM", first_per_key(folded), F.upper(forms[0])))
    return steps
