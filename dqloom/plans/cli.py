"""Command line: run, ad-hoc, corrections, probe, seed, outliers, all."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import memory
from ..operators.fields import CLEANERS
from ..session import build_session
from ..sources import config as conf
from ..sources import sinks, tables
from ..sources.files import read_file
from ..sources.remember import Remembered
from ..sources.state import StateStore
from .pipeline import Endpoint


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dqloom")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for o in options:
            p.add_argument(f"--{o}")
        return p

    run = command("run", "config", "base", "input", "table", "state", "out")
    run.add_argument("--mode", choices=["auto", "initial", "incremental"], default="auto")
    run.add_argument("--dry-run", action="store_true")
    command("ad-hoc", "config", "base", "input", "table", "query", "sql-file", "output")
    command("corrections", "config", "base", "file", "memory", "history")
    command("probe", "table", "created")
    command("seed", "state", "api-id", "watermark")
    command("outliers", "table", "value", "out", "memory")
    every = sub.add_parser("all")
    every.add_argument("configs", nargs="+")
    every.add_argument("--state")
    return top


def apply_corrections(spark: SparkSession, config: dict, sheet: DataFrame, folder: str | None = None, history: str | None = None) -> list[str]:
    """Puts a sheet's rows (Champ, Input, Label_Attendu) into the endpoint's memory, each field's inputs keyed by the field's own cleaner.

    Champ is the field's name or its raw column, in any case. Rows of unknown fields are left out and named in the result.
    """
    store = Remembered(spark, folder or config["remember"], config["api_id"])
    blocks = {n: b for n, b in config["fields"].items() if b["type"] == "categorical"}
    names = {alias.lower(): n for n, b in blocks.items() for alias in (b["col_in"], n)}
    asked = F.lower(F.trim("Champ"))
    report = memory.correction_report(sheet.withColumn("Champ", asked), list(names)).collect()
    unknown = sorted(r["Champ"] or "" for r in report if not r["known"])
    for name in unknown:
        print(f"unknown field in the corrections: {name!r}", file=sys.stderr)
    incomplete = sum(r["n_incomplete"] for r in report)
    if incomplete:
        print(f"{incomplete} incomplete rows were left out", file=sys.stderr)
    new = {}
    for name, block in blocks.items():
        rows = sheet.where(asked.isin([a for a, n in names.items() if n == name]))
        new[name] = memory.correction_rows(rows, CLEANERS[block["kind"]](F.col("Input")), preserve_case=block["kind"] == "message_type").select("k", "v")
    store.save("memory", new)
    path = history or store.path("history")
    empty = spark.createDataFrame([], "date string, champ string, input string, label_attendu string")
    known = spark.read.parquet(path) if sinks.exists(spark, path) else empty
    rows = sheet.select(F.lit(f"{datetime.now():%Y-%m-%d}").alias("date"), F.col("Champ").alias("champ"), F.col("Input").alias("input"), F.col("Label_Attendu").alias("label_attendu"))
    sinks.write_table(memory.append_history(known, rows), path)
    return unknown


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session()
    if args.command == "run":
        endpoint = Endpoint(spark, conf.load_config(args.config, args.base), StateStore(args.state) if args.state else None)
        result = endpoint.run(args.input or spark.read.parquet(args.table), args.mode, args.dry_run, args.out)
        print(result.reports.get("quality", ""))
    elif args.command == "ad-hoc":
        endpoint = Endpoint(spark, conf.load_config(args.config, args.base))
        query = open(args.sql_file, encoding="utf-8").read() if args.sql_file else args.query
        df = read_file(spark, args.input) if args.input else tables.guarded_sql(spark, query, source=spark.read.parquet(args.table)) if query else spark.read.parquet(args.table)
        sinks.write_csv(endpoint.extract(df), args.output or "extraction.csv")
    elif args.command == "corrections":
        apply_corrections(spark, conf.load_config(args.config, args.base), read_file(spark, args.file), args.memory, args.history)
    elif args.command == "probe":
        df = spark.read.parquet(args.table)
        tables.probe(df, args.created).show()
        tables.probe_by_year(df, args.created).show()
    elif args.command == "seed":
        print("seeded" if StateStore(args.state).seed(args.api_id, datetime.fromisoformat(args.watermark)) else "a state exists")
    elif args.command == "outliers":
        rows = spark.read.parquet(args.table).where(F.col(args.out) == "OUTLIER")
        none = spark.createDataFrame([], "k string, v string")
        memory.outlier_origin(rows, spark.read.parquet(args.memory) if args.memory else none, none, args.value).groupBy("origin").count().show()
    else:
        failed = 0
        for path in args.configs:  # one after another; a failure doesn't stop the next
            try:
                config = conf.load_config(path)
                Endpoint(spark, config, StateStore(args.state) if args.state else None).run(spark.read.parquet(config["table"]))
            except Exception as error:
                failed += 1
                print(f"{path}: {error}", file=sys.stderr)
        return 1 if failed else 0
    return 0
