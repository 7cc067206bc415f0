"""Chaining of statements: what an account's statement starts with must be what the one before ended with."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import number_text, to_number, to_time
from .validation import ERROR, WARNING, StatementColumns, no_activity_row


def chained(df: DataFrame, cols: StatementColumns, order: list[str]) -> DataFrame:
    """Statements with a readable instant and some activity, plus t_, same_ (statements of that account and instant), nth_, and
    for the first of each instant the previous closing balance and instant. Null keys form a group like any other.
    """
    keys = [c for c in cols.grouping if c in df.columns]
    rows = df.withColumns({"t_": to_time(df, cols.day), "open_": to_number(df, cols.opening), "close_": to_number(df, cols.closing)}).where(~no_activity_row(df, cols) & F.col("t_").isNotNull())
    group = [F.col(f"`{k}`") for k in keys]
    tie = [F.col(f"`{o}`") for o in order] or [F.lit(0)]
    instant = Window.partitionBy(*group, "t_")
    rows = rows.withColumns({"same_": F.count("*").over(instant), "nth_": F.row_number().over(instant.orderBy(*tie))})
    # Only firsts are chained; others sort after them in one group, so the partitioning by account serves both windows.
    line = Window.partitionBy(*group, F.col("nth_") == 1).orderBy("t_", *tie)
    first = F.col("nth_") == 1
    return rows.withColumns({"prev_close_": F.when(first, F.lag("close_").over(line)), "prev_t_": F.when(first, F.lag("t_").over(line))})


def temporal_continuity(df: DataFrame, cols: StatementColumns = StatementColumns(), order: list[str] | None = None) -> DataFrame:
    """Violations in long form: several statements of one instant (one row each), a break of the balance, a gap of days."""
    if not [c for c in cols.grouping if c in df.columns]:
        rows = df.limit(0).withColumns({c: F.lit(None) for c in ("t_", "open_", "prev_close_", "prev_t_")}).withColumns({"same_": F.lit(0), "nth_": F.lit(0)})
    else:
        rows = chained(df, cols, order or [])
    delta = F.bround(F.col("open_") - F.col("prev_close_"), 2)
    pair = F.col("open_").isNotNull() & F.col("prev_close_").isNotNull() & F.col("prev_t_").isNotNull()
    days = F.floor((F.unix_micros("t_") - F.unix_micros("prev_t_")) / F.lit(86_400_000_000)).cast("int")
    broken = pair & (F.abs(delta) > cols.tolerance)
    late = pair & ~broken & (days > 1)
    before = F.to_date("prev_t_").cast("string")
    item = lambda detail, delta, severity: F.struct(detail.alias("Detail"), delta.cast("double").alias("Delta"), F.lit(severity).alias("Severity"))
    double = F.concat(F.col("same_").cast("string"), F.lit(" lignes pour la même date "), F.date_format("t_", "yyyy-MM-dd HH:mm:ss"), F.lit(" (compte ambigu)"))
    jump = F.concat(F.lit(f"{cols.opening}="), number_text(F.col("open_")), F.lit(f" != {cols.closing}(J-1)="), number_text(F.col("prev_close_")), F.lit(" (relevé précédent "), before, F.lit(")"))
    gap = F.concat(F.lit("Écart de "), days.cast("string"), F.lit(" jours depuis le relevé précédent ("), before, F.lit(")"))
    hits = F.array_compact(F.array(F.when((F.col("same_") > 1) & (F.col("nth_") == 1), item(double, F.lit(None), ERROR)), F.when(broken, item(jump, delta, ERROR)), F.when(late, item(gap, F.lit(0.0), WARNING))))
    shown = [F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in cols.shown()]
    return rows.select(*shown, F.explode(hits).alias("hit")).select(*[F.col(f"`{c}`") for c in cols.shown()], F.lit("TEMPORAL_CONTINUITY").alias("Rule"), "hit.Detail", "hit.Delta", "hit.Severity")
