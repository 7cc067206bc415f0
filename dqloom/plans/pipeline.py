"""A run of an endpoint: load, resolve, validate, measure, write, remember."""

from __future__ import annotations

import importlib
import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as words
from ..operators import fields as field_ops
from ..operators import memory, quality, report, resolver
from ..operators.cascade import cut
from ..operators.fields import memory_table
from ..operators.no_activity import add_global_witness
from ..operators.validation import DueColumns, StatementColumns, TransactionColumns, validate_due_dates, validate_statements, validate_transactions
from ..sources import config as conf
from ..sources import sinks, tables
from ..sources.files import read_file
from ..sources.remember import Remembered
from ..sources.state import StateStore, advanced

log = logging.getLogger("dqloom")


@dataclass
class FieldResult:
    """What one field adds: columns on the rows, its mapping table, its outliers or anomalies."""

    name: str
    block: dict
    mapping: DataFrame | None = None
    outliers: DataFrame | None = None
    anomalies: DataFrame | None = None
    verdicts: list[DataFrame] = field(default_factory=list)
    matches: list[DataFrame] = field(default_factory=list)
    fingerprint: str | None = None


def _asker(block: dict, client: Callable, told: list) -> Callable:
    """The resolver of a field: asks about what is left open; told gets the answers, asked once."""
    settings = block.get("resolver") or {}
    chosen = resolver.Options(**{k: int(settings[k]) for k in ("batch", "concurrency", "most") if k in settings})

    def run(resolved: DataFrame, raw: str) -> DataFrame:
        left = (F.col("method").isNull() & (F.col("clean") != "")) | (F.col("method") == "check")
        pending = resolved.where(left).select(F.col(f"`{raw}`").alias("value"))
        answers = cut(resolver.ask(pending, client, settings.get("labels"), chosen))
        told.append(answers)
        return resolver.settle(resolved, raw, answers)

    return run


def _named(path: str) -> Callable:
    """The function that "module:function" names."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _categorical(df: DataFrame, name: str, block: dict, options: dict) -> tuple[DataFrame, FieldResult]:
    raw, out = block["col_in"], block["field_out"]
    if raw not in df.columns:
        log.warning("%s: column %s isn't there, the field is left out", name, raw)
        return df, FieldResult(name, block)
    kind, flow = block["kind"], block.get("flow", "OUT")
    given = words.options_from(kind, words.load_json(block["dictionary"]), flow) if block.get("dictionary") else {}
    if block.get("memory"):
        given["memory"] = words.memory_from(block["memory"])
    own = dict(options.get(name, {}))
    store, client = own.pop("remembered", None), own.pop("client", None)
    given |= dict(block.get("options") or {}) | own
    if store is not None:  # what was validated by hand, in the file, comes before what was remembered
        written = memory_table(given.get("memory"), df.sparkSession).select("k", "v")
        given["memory"] = cut(written.unionByName(store.memory(name).join(written.select("k"), "k", "left_anti").select("k", "v")))
    result = FieldResult(name, block)
    if client is None and (block.get("resolver") or {}).get("client"):
        client = _named(block["resolver"]["client"])
    if kind == "local_entity":
        if store is not None:
            result.fingerprint = memory.base_fingerprint(given["base"])
            given["cache"] = cut(store.matches(name, result.fingerprint))
        if client is not None:
            given["arbitrator"] = lambda near: resolver.arbitrate(near, client)
        rows = field_ops.entity_field(df, raw, out, block.get("tax_id"), witness=block.get("witness"), settled=result.matches, **given)
    else:
        asker = _asker(block, client, result.verdicts) if client is not None else None
        rows = field_ops.field(df, kind, raw, out, block.get("witness"), block.get("categories"), asker, **given, **({"flow": flow} if kind == "message_type" else {}))
    result.mapping, result.outliers = quality.classification(rows, raw, out), quality.outlier_stats(rows, raw, out, block.get("bank", "RefBanque"))
    return rows, result


def _columns(cls, block: dict):
    known = {k: tuple(v) if isinstance(v, list) else v for k, v in block.items() if k in cls.__dataclass_fields__ and cls.__dataclass_fields__[k].init}
    return cls(**known)


def _validated(df: DataFrame, name: str, block: dict, options: dict) -> tuple[DataFrame, FieldResult]:
    kind, cls = {"transactions": (validate_transactions, TransactionColumns), "due_dates": (validate_due_dates, DueColumns), "statements": (validate_statements, StatementColumns)}[block["type"]]
    rows, found = kind(df, _columns(cls, block))
    return rows, FieldResult(name, block, anomalies=found)


#: Builders by a field's type; more can be registered.
BUILDERS: dict[str, Callable] = {"categorical": _categorical, "transactions": _validated, "due_dates": _validated, "statements": _validated}


@dataclass
class Run:
    rows: DataFrame
    results: list[FieldResult]
    indicators: DataFrame
    history: DataFrame
    sheets: dict[str, DataFrame]
    reports: dict[str, str] = field(default_factory=dict)
    mode: str = "file"
    news: DataFrame | None = None
    mappings: dict[str, DataFrame] = field(default_factory=dict)


class Endpoint:
    """One configured endpoint. preprocess may add columns before the fields see the rows; options has dictionaries per field.

    remember, a folder in the configuration, holds what runs over a source remember: verdicts of the resolvers (clients, by field, or
    resolver.client of a field as "module:function"), matches against the name base and every mapping. reports may add reports of a run.
    """

    def __init__(
        self, spark: SparkSession, config: dict, state: StateStore | None = None, outlets: sinks.Outlets | None = None, preprocess: Callable[[DataFrame], DataFrame] | None = None, options: dict | None = None,
        clients: dict[str, Callable] | None = None, reports: Callable[[Run], dict[str, str]] | None = None,
    ):
        conf.validate_config(config, {*field_ops.RESOLVERS, "local_entity"})
        self.spark, self.config, self.state = spark, config, state
        self.outlets, self.options = outlets or sinks.Outlets(), options or {}
        self.clients, self.report_hook = clients or {}, reports
        self.remembered = Remembered(spark, config["remember"], config["api_id"]) if config.get("remember") else None
        self.preprocess = preprocess or self._witness

    def _witness(self, df: DataFrame) -> DataFrame:
        block = self.config.get("global_witness")
        return add_global_witness(df, block["ids"], block["amounts"], block["name"]) if block and all(c in df.columns for c in block["ids"]) else df

    def load(self, source: DataFrame | str, mode: str = "auto") -> tuple[DataFrame, str]:
        """Rows to process and the mode that auto stands for: initial without a watermark, else incremental; a path is a file."""
        if isinstance(source, str):
            return read_file(self.spark, source), "file"
        columns, missing = conf.reconcile(conf.required_columns(self.config), conf.primary_columns(self.config), source.columns)
        if missing:
            log.warning("columns not in the source: %s", ", ".join(missing))
        created = self.config.get("dt_cr_col", "dtCr")
        watermark = self.state.read(self.config["api_id"]).watermark if self.state else None
        mode = ("incremental" if watermark else "initial") if mode == "auto" else mode
        if mode == "incremental":
            return tables.scan_delta(source, created, watermark, columns), mode
        return tables.scan(source, columns, created, conf.initial_since((self.config.get("load") or {}).get("initial_since"))), mode

    def process(self, df: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, list[FieldResult]]:
        """All fields (or those named) over the rows, validations last: they see the rows as they came, plus columns."""
        blocks = {n: b for n, b in self.config["fields"].items() if names is None or n in names}
        rows, results = df, []
        for name, block in sorted(blocks.items(), key=lambda x: x[1]["type"] != "categorical"):
            own = {k: v for k, v in (("remembered", self.remembered), ("client", self.clients.get(name))) if v is not None and block["type"] == "categorical"}
            rows, result = BUILDERS[block["type"]](rows, name, block, {**self.options, name: {**self.options.get(name, {}), **own}} if own else self.options)
            results.append(result)
        return rows, results

    def applicable(self, df: DataFrame) -> list[str]:
        """Fields whose columns are there."""
        return [n for n, b in self.config["fields"].items() if (b.get("col_in") in df.columns if b["type"] == "categorical" else all(c in df.columns for c in (b.get("amount"), b.get("opening")) if c))]

    def run(self, source: DataFrame | str, mode: str = "auto", dry: bool = False, out: str | None = None) -> Run:
        """One run. State is written last, after all outputs; a dry run leaves publishing and notices out but not outputs and state.

        A failure is recorded and told (offline runs over files do neither) and raised again.
        """
        started, offline = datetime.now(timezone.utc), isinstance(source, str)
        api, resolved_mode = self.config["api_id"], "file" if offline else mode
        try:
            raw, resolved_mode = self.load(source, mode)
            run = self._measured(self.preprocess(raw), resolved_mode, started)
            folder = out or sinks.output_dir(self.config.get("output_base"), api, self.config.get("local_dir", f"out/{api}"), offline)
            sinks.write_workbook(run.sheets, folder)
            for name, body in run.reports.items():
                sinks.write_text(self.spark, body, f"{folder.rstrip('/')}/{name}.md")
            if self.remembered and not offline:
                self._remember(run)
            one = run.indicators.first()
            latest = tables.max_created(raw, self.config.get("dt_cr_col", "dtCr"))
            if not dry and not offline:
                self.outlets.deliver(folder)
            if self.state and not offline:
                self.state.write(advanced(self.state.read(api), True, resolved_mode, one["n_rows"], one["n_outlier_rows"], latest, started))
            if not dry and not offline:
                self.outlets.tell("OK", one.asDict() | (run.news.first().asDict() if run.news is not None else {}))
            return run
        except Exception as error:
            log.exception("run of %s failed", api)
            if not offline:
                if self.state:
                    self.state.write(advanced(self.state.read(api), False, resolved_mode, 0, 0, None, started))
                if not dry:
                    self.outlets.tell("KO", error=error)
            raise

    def _remember(self, run: Run) -> None:
        """After the outputs and before the state: verdicts, matches that hold for this base, and what every value maps to."""
        self.remembered.save("memory", {r.name: resolver.remembered(a) for r in run.results for a in r.verdicts})
        matches = {r.name: memory.cacheable_matches(m.withColumnsRenamed({"k": "clean", "v": "value"})).select(F.lit(r.fingerprint).alias("fingerprint"), "k", "v", "method") for r in run.results for m in r.matches}
        self.remembered.save("matches", matches)
        self.remembered.save("mappings", run.mappings)

    def _measured(self, df: DataFrame, mode: str, started: datetime) -> Run:
        rows, results = self.process(df)
        rows = rows.persist()  # indicators, sheets and reports read it
        outs = {r.name: r.block["field_out"] for r in results if r.mapping is not None}
        found = [r.anomalies for r in results if r.anomalies is not None]
        anomalies = None
        for a in found:
            anomalies = a if anomalies is None else anomalies.unionByName(a, allowMissingColumns=True)
        indicators = quality.run_indicators(rows, list(outs.values()))
        own = {r.name: r.mapping.select(F.col(f"`{r.block['col_in']}`").cast("string").alias("raw"), F.col(f"`{r.block['field_out']}`").alias("value")) for r in results if r.mapping is not None}
        # All that earlier runs have mapped, this run's values in place of theirs; over files a run is its own history.
        whole = {n: cut(memory.upsert(self.remembered.mapping(n), m.dropDuplicates(["raw"]), ["raw"])) if self.remembered and mode != "file" else m for n, m in own.items()}
        empty = self.spark.createDataFrame([], "raw string, out string")
        history = quality.cumulative_stats([(m, "raw", "value") for m in whole.values()] or [(empty, "raw", "out")])
        sheets = {f"mapping_{r.name}": whole[r.name].select(F.col("raw").alias(r.block["col_in"]), F.col("value").alias(r.block["field_out"])) for r in results if r.mapping is not None}
        created = self.config.get("dt_cr_col", "dtCr")
        news = [quality.new_values(rows, r.block["col_in"], r.block["field_out"], [created] if created in rows.columns else [r.block["col_in"]]) for r in results if r.mapping is not None]
        for r in results:
            if r.anomalies is not None:
                capped, whole = sinks.cap_anomalies(r.anomalies, r.anomalies.columns, int((self.config.get("reports") or {}).get("max_anomaly_rows_excel", sinks.ANOMALY_ROWS)))
                sheets[f"anomalies_{r.name}"] = capped
                if whole is not None:
                    sheets[f"anomalies_{r.name}_all"] = whole
        labels = (self.config.get("reports") or {}).get("labels", {})
        by_field = quality.outliers_by_field(rows, outs, anomalies) if outs else quality.outliers_by_field(rows, {"-": next(iter(rows.columns))}, anomalies).where("champ <> '-'")
        synthesis = quality.field_synthesis(by_field, list(dict.fromkeys(labels.values())) or [*outs], labels or {n: n for n in outs})
        bank = self.config.get("bank_col", "RefBanque")
        reports = {"quality": report.quality_markdown(self.config["api_id"], mode, started, (datetime.now(timezone.utc) - started).total_seconds(), indicators, history)}
        detail_tables = {r.name: (r.outliers, r.block["col_in"]) for r in results if r.outliers is not None and bank in r.outliers.columns}
        numbers = [(r.anomalies, r.block.get("number") or r.block.get("account") or r.block.get("reference")) for r in results if r.anomalies is not None and bank in r.anomalies.columns]
        if detail_tables or numbers:
            detail = quality.bank_detail(detail_tables, numbers, labels, bank)
            top = int((self.config.get("reports") or {}).get("top_n_outliers_detail", 100))
            known = detail.select("bank").distinct().count()
            reports["outliers"] = report.outlier_markdown(self.config["api_id"], mode, started, synthesis, quality.top_banks(detail, top), min(top or known, known), known)
        run = Run(rows, results, indicators, history, sheets, reports, mode, mappings=own)
        if news:
            errors = sum(r.anomalies.where("Severity = 'ERROR'").count() for r in results if r.anomalies is not None)
            run.news = quality.mail_counters(news, errors)
        if self.report_hook is not None:
            run.reports |= self.report_hook(run)
        return run

    def extract(self, df: DataFrame) -> DataFrame:
        """Ad-hoc: the fields that apply, results beside their raw columns. The witness hook runs here too when its inputs exist."""
        prepared = self.preprocess(df)
        rows, results = self.process(prepared, self.applicable(prepared))
        return sinks.extraction_frame(rows, df.columns, {r.block["col_in"]: r.block["field_out"] for r in results if r.mapping is not None})


def load_options(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)
