"""The port to a paid or manual resolver of values that no rule could tell.

A client takes a batch of values and returns numbered answer lines. Three outcomes are kept apart: a
verdict (a label), the verdict OUTLIER, and no verdict (failure or quota), which is never remembered and comes up again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cascade import OUTLIER

#: The format of an answer line.
ANSWER = r"^\s*(\d+)[.)]\s*(.+?)\s*$"
VERDICT, FAILED, DEFERRED = "verdict", "technical_failure", "deferred"


def offline(values: list[str]) -> str:
    """The default client: nobody to ask."""
    raise ConnectionError("no resolver is configured")


@dataclass(frozen=True)
class Options:
    batch: int = 30
    concurrency: int = 4
    most: int = 0  # values asked about in a run; 0 for all. The rest is deferred


def parse_answers(answer: str, count: int, labels: list[str] | None = None) -> dict[int, str]:
    """Answers by number from 1; with a closed list of labels, what isn't on it is an OUTLIER."""
    known = {x.upper(): x for x in labels} if labels is not None else None
    found = {}
    for line in answer.splitlines():
        m = re.match(ANSWER, line)
        if m and 1 <= int(m[1]) <= count:
            found[int(m[1])] = m[2] if known is None else known.get(m[2].upper(), OUTLIER)
    return found


def answers_frame(lines: DataFrame, line: str = "line") -> DataFrame:
    """Answer lines of a table as number and answer."""
    return lines.where(F.col(line).rlike(ANSWER)).select(F.regexp_extract(line, ANSWER, 1).cast("int").alias("number"), F.regexp_extract(line, ANSWER, 2).alias("answer"))


def ask(pending: DataFrame, client: Callable[[list[str]], str], labels: list[str] | None = None, options: Options = Options()) -> DataFrame:
    """pending (value) as value, label, status. Batches run in parallel tasks; a batch that fails leaves its values without verdict."""
    asked = pending.select("value").distinct()
    now = asked.orderBy("value").limit(options.most) if options.most else asked

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["value"].tolist()
            for at in range(0, len(values), options.batch):
                batch = values[at : at + options.batch]
                try:
                    found = parse_answers(client(batch), len(batch), labels)
                    rows = [(v, found.get(i, OUTLIER), VERDICT) for i, v in enumerate(batch, 1)]
                except Exception:  # a client's failure is an outcome, whatever its kind
                    rows = [(v, None, FAILED) for v in batch]
                yield pd.DataFrame(rows, columns=["value", "label", "status"])

    schema = "value string, label string, status string"
    answered = now.repartition(options.concurrency).mapInPandas(run, schema)
    if not options.most:
        return answered
    later = asked.join(now, "value", "left_anti").select("value", F.lit(None).cast("string").alias("label"), F.lit(DEFERRED).alias("status"))
    return answered.unionByName(later)


def settle(resolved: DataFrame, raw: str, answers: DataFrame, open_: Column | None = None) -> DataFrame:
    """resolved with the answers to its open values: a label by CLAUDE, else OUTLIER."""
    open_ = open_ if open_ is not None else (F.col("method").isNull() & (F.col("clean") != "")) | (F.col("method") == "check")
    joined = resolved.join(answers.select(F.col("value").alias("asked_"), "label"), F.col(f"`{raw}`") == F.col("asked_"), "left")
    told = F.col("label").isNotNull() & (F.col("label") != OUTLIER)
    return joined.select(
        *[F.col(f"`{c}`") for c in resolved.columns if c not in ("value", "method")],
        F.when(open_, F.when(told, F.col("label")).otherwise(OUTLIER)).otherwise(F.col("value")).alias("value"),
        F.when(open_, F.when(told, "CLAUDE").otherwise(OUTLIER)).otherwise(F.col("method")).alias("method"),
    )


def remembered(answers: DataFrame) -> DataFrame:
    """What goes into memory: verdicts alone, OUTLIER among them."""
    return answers.where(F.col("status") == VERDICT).select(F.col("value").alias("k"), F.coalesce("label", F.lit(OUTLIER)).alias("v"))


def arbitrate(near: DataFrame, client: Callable[[list[str]], str], options: Options = Options()) -> DataFrame:
    """For labels with their nearest names (label, rank, name), which of the names it is: label, name or OUTLIER, method, status."""
    asked = near.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("names"))
    lines = asked.select("label", "names", F.concat_ws(" | ", F.col("label"), F.array_join(F.transform("names", lambda n: F.concat(n["rank"].cast("string"), F.lit(") "), n["name"])), " ")).alias("value"))
    told = ask(lines, client, None, options).withColumnRenamed("label", "answer")
    joined = lines.join(told, "value")
    number = F.col("answer").try_cast("int")
    name = F.when(number.between(1, F.size("names")), F.get(F.col("names.name"), number - 1))
    done = F.col("status") == VERDICT
    return joined.select("label", F.coalesce(F.when(done, name), F.lit(OUTLIER)).alias("value"), F.when(done, "DGI_CLAUDE_ARBITRAGE").otherwise(OUTLIER).alias("method"), "status")
