import json
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from dqloom import catalog
from dqloom.operators import memory
from dqloom.plans import cli
from dqloom.plans.pipeline import Endpoint
from dqloom.sources import config as conf
from dqloom.sources import files, sinks, tables
from dqloom.sources.state import RunState, StateStore, advanced
from dqloom.streaming.increment import new_outliers_by_hour, run_available

SMALL = "/root/testdata/sf0.001"
CONFIG = {
    "api_id": "T1", "dt_cr_col": "dtCr", "load": {"initial_since": "2024-01-02"},
    "fields": {
        "devise": {"type": "categorical", "kind": "currency", "col_in": "Devise", "field_out": "Devise_Normalisée", "witness": "ReferenceTransaction"},
        "tx": {"type": "transactions", "reference": "ReferenceTransaction", "amount": "MontantTransaction", "rate": "TauxDeChange", "when": "DateTransaction", "created": "dtCr"},
    },
    "extra_columns": ["RefBanque", "Missing"], "reports": {"labels": {"devise": "Devise", "DATE_VALIDITY": "Date"}, "max_anomaly_rows_excel": 2},
}
OPTIONS = {"devise": {"codes": ["USD"], "numbers": {}}}
ROWS = [(f"R{i}", "B1" if i % 2 else "B2", datetime(2024, 1, 1), datetime(2024, 1, i), float(i - 3), 1.0, ["usd", "zz", None][i % 3], "unused") for i in range(1, 9)]
SCHEMA = "ReferenceTransaction string, RefBanque string, DateTransaction timestamp, dtCr timestamp, MontantTransaction double, TauxDeChange double, Devise string, Unused string"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "supplier", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(catalog.SQL[name])
    got = catalog.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    text = lambda rows: sorted(str(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in rows)
    assert text(got.select(*want.columns).collect()) == text(want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_modes_watermark_and_counters(spark, tmp_path):
    store, told = StateStore(str(tmp_path)), []
    outlets = sinks.Outlets(notify=told.append)
    endpoint = Endpoint(spark, CONFIG, store, outlets, options=OPTIONS)
    df = spark.createDataFrame(ROWS, SCHEMA)
    first = endpoint.run(df.where("dtCr < '2024-01-06'"), out=str(tmp_path / "o"))
    assert first.mode == "initial" and first.rows.count() == 4 and "Unused" not in first.rows.columns
    state = store.read("T1")
    assert state.watermark == datetime(2024, 1, 5) and state.cumulative_rows == 4 and state.last_run_status == "OK"
    second = endpoint.run(df, out=str(tmp_path / "o"))
    assert second.mode == "incremental" and second.rows.count() == 3 and store.read("T1").cumulative_rows == 7
    third = endpoint.run(df, out=str(tmp_path / "o"))  # an empty delta
    assert third.rows.count() == 0 and store.read("T1").watermark == datetime(2024, 1, 8) and store.read("T1").cumulative_runs == 3
    assert [t["status"] for t in told] == ["OK"] * 3
    assert spark.read.parquet(str(tmp_path / "o" / "anomalies_tx")).count() <= 2
    with pytest.raises(conf.ConfigError):
        endpoint.run(df.drop("Devise"))
    assert store.read("T1").last_run_status == "KO" and store.read("T1").watermark == datetime(2024, 1, 8) and store.read("T1").cumulative_runs == 4
    assert told[-1] == {"status": "KO", "counters": {}, "error": "configuration", "attachments": []}


def test_two_deltas_give_what_one_snapshot_gives(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    whole = Endpoint(spark, CONFIG, options=OPTIONS).process(df)[0]
    parts = [Endpoint(spark, CONFIG, options=OPTIONS).process(p)[0] for p in (df.where("dtCr < '2024-01-04'"), df.where("dtCr >= '2024-01-04'").orderBy(F.desc("dtCr")))]
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts[0].unionByName(parts[1]).collect()))


def test_dry_and_offline_runs(spark, tmp_path):
    store, told = StateStore(str(tmp_path / "s")), []
    endpoint = Endpoint(spark, CONFIG, store, sinks.Outlets(notify=told.append), options=OPTIONS)
    endpoint.run(spark.createDataFrame(ROWS, SCHEMA), dry=True, out=str(tmp_path / "a"))
    assert store.read("T1").last_run_status == "OK" and not told  # outputs and state are written, nothing is sent
    path = tmp_path / "in.csv"
    path.write_text("﻿ReferenceTransaction;RefBanque;Devise;MontantTransaction;TauxDeChange;DateTransaction;dtCr\nR1;B;usd;1,5;2;2024-01-01;2024-01-02\nR2;B;;x;2;2024-01-01;2024-01-02\n", encoding="utf-8")
    run = endpoint.run(str(path), out=str(tmp_path / "b"))
    assert run.mode == "file" and store.read("T1").cumulative_runs == 1 and run.rows.count() == 2
    assert run.reports["quality"].startswith("# Rapport de qualité — T1") and "| Devise | 1 |" in run.reports["outliers"]


def test_extraction_puts_results_beside_their_source(spark):
    out = Endpoint(spark, CONFIG, options=OPTIONS).extract(spark.createDataFrame(ROWS, SCHEMA).drop("MontantTransaction"))
    assert out.columns == ["ReferenceTransaction", "RefBanque", "DateTransaction", "dtCr", "TauxDeChange", "Devise", "Devise_Normalisée", "Unused"]


def test_state_rules(tmp_path):
    now, later = datetime(2024, 1, 1), datetime(2024, 1, 2)
    ok = advanced(RunState("A"), True, "initial", 5, 2, now, now)
    assert advanced(ok, True, "incremental", 0, 0, None, later).last_dtcr_processed == ok.last_dtcr_processed
    ko = advanced(ok, False, "incremental", 9, 9, later, later)
    assert (ko.last_dtcr_processed, ko.cumulative_rows, ko.cumulative_runs, ko.last_run_status) == (ok.last_dtcr_processed, 5, 2, "KO")
    store = StateStore(str(tmp_path))
    assert store.seed("A", now) and not store.seed("A", later) and store.read("A").watermark == now


def test_configuration(tmp_path):
    assert conf.deep_merge({"a": {"x": 1, "y": 2}, "l": [1]}, {"a": {"y": 3}, "l": [2]}) == {"a": {"x": 1, "y": 3}, "l": [2]}
    with pytest.raises(conf.ConfigError, match="unknown type.*missing key amount|missing key"):
        conf.validate_config({"api_id": "x", "fields": {"a": {"type": "?"}, "b": {"type": "due_dates", "number": "n"}}})
    assert conf.required_columns(CONFIG)[:2] == ["Devise", "ReferenceTransaction"] and "Missing" in conf.required_columns(CONFIG)
    assert conf.reconcile(["a", "B", "c"], ["a"], ["A", "b"]) == (["A", "b"], ["c"])
    with pytest.raises(conf.ConfigError):
        conf.reconcile(["a"], ["a"], ["b"])
    assert conf.initial_since("2024-01-02") == datetime(2024, 1, 2) and conf.initial_since("") is None
    with pytest.raises(conf.ConfigError):
        conf.initial_since("soon")
    (tmp_path / "b.yaml").write_text("a: {x: 1}\n")
    (tmp_path / "c.yaml").write_text("a: {y: 2}\n")
    assert conf.load_config(str(tmp_path / "c.yaml"), str(tmp_path / "b.yaml")) == {"a": {"x": 1, "y": 2}}


def test_sources(spark, tmp_path):
    for bad in ("DELETE FROM x", "SELECT 1; DROP TABLE x", "INSERT INTO t SELECT 1", "  "):
        with pytest.raises(ValueError):
            tables.guarded_sql(spark, bad)
    assert tables.guarded_sql(spark, "-- note\nWITH a AS (SELECT ';' AS x) SELECT x FROM a;").first().x == ";"
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("08S01 Communication link failure")
        return "ok"

    assert tables.with_retries(flaky, 3, 5, waits.append) == "ok" and waits == [5, 10]
    with pytest.raises(ValueError):
        tables.with_retries(lambda: int("x"), 3, 5, waits.append)
    assert tables.select_clause(["a", "b"], tables.long_text_columns({"a": "nvarchar(max)", "b": "int"})) == "CAST([a] AS NVARCHAR(4000)) AS [a], [b]"
    latin = tmp_path / "l.csv"
    latin.write_bytes("naïf,b\né–€,\n".encode("cp1252"))
    df = files.read_file(spark, str(latin))
    assert df.columns == ["naïf", "b"] and tuple(df.first()) == ("é–€", "")
    tab = tmp_path / "t.tsv"
    tab.write_text('a\tb\n1\t"x\ny"\n')
    assert tuple(files.read_file(spark, str(tab)).first()) == ("1", "x\ny")
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(files.EmptySource):
        files.read_file(spark, str(tmp_path / "e.csv"))
    assert files.optional_table(spark, None, "a int").count() == 0 and files.optional_table(spark, str(tmp_path / "no.csv"), "a int").count() == 0
    assert tables.max_created(spark.createDataFrame([("2024-01-01",), ("x",)], "c string"), "c") == datetime(2024, 1, 1)


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("t", F.lit("é"))
    sinks.write_table(df, str(tmp_path / "t"))
    sinks.write_table(spark.read.parquet(str(tmp_path / "t")).where("id < 4"), str(tmp_path / "t"))  # over the table that it reads
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    sinks.write_csv(df.limit(1), str(tmp_path / "c"))
    assert next((tmp_path / "c.csv").glob("part-*")).read_bytes() == "﻿id;t\n0;é\n".encode()
    sheets = sinks.split_sheets(df, "s", ["id"], 4)
    assert {n: [r.id for r in d.orderBy("id").collect()] for n, d in sheets.items()} == {"s": [0, 1, 2, 3], "s_2": [4, 5, 6, 7], "s_3": [8, 9]}
    assert sinks.output_dir("base", "X", "l", False) == "base/X" and sinks.output_dir("base", "X", "l", True) == "l"
    assert not sinks.Outlets(publish=lambda p: 1 / 0).deliver("x")


def test_history_and_mappings(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "date string, champ string, input string, label_attendu string")
    out = memory.append_history(rows(("d1", "a", "b", "c")), rows(("d3", "a", "b", "c"), ("d3", "a", "b", "d"), ("d2", "a", "b", "d")))
    assert sorted(map(tuple, out.collect())) == [("d1", "a", "b", "c"), ("d2", "a", "b", "d")]


def test_stream_of_files(spark, tmp_path):
    src, out, mark = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "mark")
    df = spark.createDataFrame(ROWS, SCHEMA)
    endpoint = Endpoint(spark, CONFIG, options=OPTIONS)
    go = lambda: run_available(spark, src, df.schema, lambda b: endpoint.process(b)[0], out, mark).awaitTermination(120)
    df.where("dtCr < '2024-01-04'").write.mode("append").parquet(src)
    go()
    df.where("dtCr >= '2024-01-04'").write.mode("append").parquet(src)
    go()
    go()
    got = spark.read.parquet(out).drop("batch")
    whole = endpoint.process(df)[0]
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_windowed_counts_on_a_stream(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).withColumn("o", F.when(F.col("Devise") == "zz", "OUTLIER")).write.parquet(str(tmp_path / "s"))
    schema = spark.read.parquet(str(tmp_path / "s")).schema
    counts = new_outliers_by_hour(spark.readStream.schema(schema).parquet(str(tmp_path / "s")), "dtCr", "o")
    q = counts.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("hours").agg(F.sum("n")).first()[0] == 3


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "t"))
    (tmp_path / "c.yaml").write_text(json.dumps(CONFIG | {"fields": {"tx": CONFIG["fields"]["tx"]}, "table": str(tmp_path / "t"), "local_dir": str(tmp_path / "o")}))
    assert cli.main(["run", "--config", str(tmp_path / "c.yaml"), "--table", str(tmp_path / "t"), "--state", str(tmp_path / "s")]) == 0
    assert "Lignes traitées | 7" in capsys.readouterr().out
    assert cli.main(["seed", "--state", str(tmp_path / "s"), "--api-id", "T1", "--watermark", "2024-01-01"]) == 0 and "a state exists" in capsys.readouterr().out
    assert cli.main(["ad-hoc", "--config", str(tmp_path / "c.yaml"), "--table", str(tmp_path / "t"), "--query", "SELECT * FROM {source} WHERE RefBanque = 'B1'", "--output", str(tmp_path / "x.csv")]) == 0
    assert cli.main(["all", str(tmp_path / "missing.yaml"), str(tmp_path / "c.yaml")]) == 1
    assert cli.main(["probe", "--table", str(tmp_path / "t"), "--created", "dtCr"]) == 0


def test_runs_remember_matches_verdicts_and_mappings(spark, tmp_path):
    base = spark.createDataFrame([("", "ALPHA TRADING COMPANY", 0), ("", "BETA SERVICES GENERAUX", 1)], "NIF string, RAISON_SOCIALE string, place int")
    config = {
        "api_id": "T2", "dt_cr_col": "dtCr", "remember": str(tmp_path / "m"),
        "fields": {
            "nature": {"type": "categorical", "kind": "nature", "col_in": "Nature", "field_out": "Nature_N", "resolver": {"labels": ["SALAIRES"]}},
            "local": {"type": "categorical", "kind": "local_entity", "col_in": "Nom", "field_out": "Nom_N"},
        },
    }
    calls, told = spark.sparkContext.accumulator(0), []

    def client(values):
        calls.add(len(values))
        return "\n".join(f"{i}. {'SALAIRES' if 'PAYE' in v.upper() else 'OUTLIER'}" for i, v in enumerate(values, 1))

    rows = [(datetime(2024, 1, 1), "paye du mois", "Alpha Trading Company"), (datetime(2024, 1, 1), "qwerty uiop", "Beta Service Generaux"), (datetime(2024, 1, 2), "paye du mois", "Alpha Trading Company"), (datetime(2024, 1, 2), "SALAIRES", "Gamma Inconnue Zzz")]
    df = spark.createDataFrame(rows, "dtCr timestamp, Nature string, Nom string")
    endpoint = Endpoint(spark, config, StateStore(str(tmp_path / "s")), sinks.Outlets(notify=told.append), options={"local": {"base": base}}, clients={"nature": client}, reports=lambda run: {"own": f"{run.mode}"})
    first = endpoint.run(df.where("dtCr < '2024-01-02'"), out=str(tmp_path / "o"))
    asked = calls.value
    assert asked == 2 and first.history.first().n_distinct_total == 4
    store = endpoint.remembered
    assert {(r.k, r.v) for r in store.memory("nature").collect()} == {("paye du mois", "SALAIRES"), ("qwerty uiop", "OUTLIER")}
    kept = {r.k: r.method for r in store.matches("local", memory.base_fingerprint(base)).collect()}
    assert kept == {"ALPHA TRADING COMPANY": "DGI_EXACT_NORM", "BETA SERVICE GENERAUX": "DGI_FUZZY_STRONG"} and store.matches("local", "other").count() == 0
    second = endpoint.run(df, out=str(tmp_path / "o"))
    assert calls.value == asked  # what was told isn't asked again
    assert {(r.Nature, r.Nature_N, r.Nature_method) for r in second.rows.collect()} == {("paye du mois", "SALAIRES", "WARM"), ("SALAIRES", "SALAIRES", "MAP")}
    assert second.rows.count() == 2 and second.history.first().n_distinct_total == 6
    assert {r.Nature for r in spark.read.parquet(str(tmp_path / "o" / "mapping_nature")).collect()} == {"paye du mois", "qwerty uiop", "SALAIRES"}
    assert (tmp_path / "o" / "quality.md").exists() and (tmp_path / "o" / "own.md").read_text() == "incremental"
    assert told[0]["counters"]["n_new_distinct"] >= 2 and "n_numeric_errors" in told[0]["counters"]


def test_corrections_are_keyed_by_the_field_s_cleaner(spark, tmp_path):
    config = {"api_id": "T3", "remember": str(tmp_path / "m"), "fields": {"local": {"type": "categorical", "kind": "foreign_entity", "col_in": "Nom", "field_out": "Nom_N"}}}
    sheet = spark.createDataFrame([("local", "Société. Épsilon", "epsilon"), ("nope", "x", "y"), ("local", "", "z")], "Champ string, Input string, Label_Attendu string")
    assert cli.apply_corrections(spark, config, sheet) == ["nope"]
    df = spark.createDataFrame([("SOCIETE EPSILON",), ("société. épsilon",)], "Nom string")
    rows, _ = Endpoint(spark, config).process(df)
    assert {(r.Nom_N, r.Nom_method) for r in rows.collect()} == {("EPSILON", "WARM")}
    assert spark.read.parquet(str(tmp_path / "m" / "history")).count() == 3 and cli.apply_corrections(spark, config, sheet) == ["nope"]
    assert spark.read.parquet(str(tmp_path / "m" / "history")).count() == 3


def test_late_bytes_decide_the_encoding_and_sheets_keep_their_order(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"a;b\n" + b"plain;line\n" * 9000 + "Société;été\n".encode("cp1252"))
    assert files.read_csv(spark, str(path)).where("a = 'Société' and b = 'été'").count() == 1
    sheets = sinks.split_sheets(spark.range(0, 1000, 1, 7).withColumnRenamed("id", "n"), "s", ["n"], 300)
    assert [sorted(r.n for r in d.collect()) for d in sheets.values()] == [list(range(i, min(1000, i + 300))) for i in range(0, 1000, 300)] and list(sheets) == ["s", "s_2", "s_3", "s_4"]


def test_a_table_left_aside_comes_back(spark, tmp_path):
    place = str(tmp_path / "t")
    sinks.write_table(spark.range(3), place)
    sinks.write_table(spark.read.parquet(place).where("id > 0"), place)
    assert spark.read.parquet(place).count() == 2
    (tmp_path / "t").rename(tmp_path / "t.old-1234")
    assert sinks.exists(spark, place) and spark.read.parquet(place).count() == 2 and not sinks.recover(spark, place)
