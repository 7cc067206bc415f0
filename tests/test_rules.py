from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dqloom.operators import quality
from dqloom.operators.chaining import temporal_continuity
from dqloom.operators.no_activity import add_global_witness
from dqloom.operators.validation import StatementColumns, TransactionColumns, validate_due_dates, validate_statements, validate_transactions

TX = "ReferenceTransaction string, RefBanque string, DateTransaction string, dtCr string, MontantTransaction string, TauxDeChange string, Devise string, Pays string"
OK = ("R", "B", "2024-01-01", "2024-01-02", "1,5", "2", "USD", "FR")


def tx(**over):
    names = [c.split()[0] for c in TX.split(", ")]
    return tuple(over.get(n, v) for n, v in zip(names, OK, strict=True))


def fired(spark, *rows, cols=TransactionColumns()):
    marked, found = validate_transactions(spark.createDataFrame(rows, TX), cols)
    flags = [r._TX_row_conforme for r in marked.collect()]
    return flags, [(r.Rule, r.Detail, r.Severity) for r in found.collect()]


def test_transaction_rules(spark):
    assert fired(spark, OK) == ([True], [])
    assert fired(spark, tx(MontantTransaction="-1"))[1] == [("AMOUNT_NON_NEGATIVE", "MontantTransaction=-1.0 < 0 (doit être positif ou nul)", "ERROR")]
    assert fired(spark, tx(TauxDeChange="x"))[1] == [("RATE_NON_NEGATIVE", "TauxDeChange non numérique/manquant : 'x'", "ERROR")]
    assert fired(spark, tx(TauxDeChange=None))[1][0][1].endswith("None")
    assert fired(spark, tx(DateTransaction="2024-01-02"))[1] == [("DATE_VALIDITY", "DateTransaction=2024-01-02 non antérieure à dtCr=2024-01-02", "ERROR")]
    assert fired(spark, tx(DateTransaction="2024-01-02 23:00:00"), cols=TransactionColumns(inclusive=True))[1] == []
    assert fired(spark, tx(DateTransaction="NA"))[1][0][1] == "DateTransaction non parsable : 'NA'"


def test_no_activity_template(spark):
    good = tx(ReferenceTransaction="na ", Devise="NA", Pays="noas", MontantTransaction="0", TauxDeChange="0,0")
    assert fired(spark, good) == ([True], [])
    flags, found = fired(spark, tx(ReferenceTransaction="NA", Devise=None, Pays="FR", MontantTransaction="0"))
    assert flags == [False] and found == [("NO_ACTIVITY_CONFORMITY", "Message sans activité (ReferenceTransaction=NA) non conforme au gabarit : Devise!=NA, Pays!=NoAs, TauxDeChange!=0", "ERROR")]


def test_due_dates(spark):
    schema = "NumCredoc string, RefBanque string, MontantEcheance double, DateEcheance timestamp, dtCr timestamp"
    day = datetime(2024, 1, 1)
    rows = [("a", "B", 1.0, day + timedelta(1), day), ("b", "B", 0.0, day + timedelta(hours=5), day), ("c", "B", None, None, day)]
    marked, found = validate_due_dates(spark.createDataFrame(rows, schema))
    assert [r._EC_row_conforme for r in marked.orderBy("NumCredoc").collect()] == [True, False, False]
    assert sorted((r.NumCredoc, r.Rule) for r in found.collect()) == [("b", "AMOUNT_POSITIVE"), ("b", "DATE_VALIDITY"), ("c", "AMOUNT_POSITIVE"), ("c", "DATE_VALIDITY")]
    assert validate_due_dates(spark.createDataFrame([], schema))[1].count() == 0


ST = "i int, RefBanque string, NomCorrespondant string, Devise string, NumCompte string, SoldeDebutJournee double, TotalMvtsDebiteursJournee double, TotalMvtsCrediteurs double, SoldeFinJournee double, DateFinJournee timestamp, dtCr timestamp"
D = datetime(2024, 3, 1)


def st(i, day, opening, closing, account="A", created=None, corr="C", cur="USD", hours=0):
    return (i, "B", corr, cur, account, opening, 0.0, closing - opening, closing, D + timedelta(day, hours=hours), created or D + timedelta(90))


def chain(spark, *rows):
    return sorted((r.Severity, round(r.Delta, 2) if r.Delta is not None else None, r.Detail) for r in temporal_continuity(spark.createDataFrame(rows, ST), StatementColumns(), ["i"]).collect())


def test_chaining(spark):
    assert chain(spark, st(1, 0, 0.0, 10.0), st(2, 1, 10.0, 20.0)) == []
    assert chain(spark, st(1, 0, 0.0, 10.0), st(2, 1, 10.01, 20.0)) == []
    broken = chain(spark, st(1, 0, 0.0, 10.0), st(2, 1, 10.02, 20.0))
    assert broken == [("ERROR", 0.02, "SoldeDebutJournee=10.02 != SoldeFinJournee(J-1)=10.0 (relevé précédent 2024-03-01)")]
    assert chain(spark, st(1, 0, 0.0, 10.0), st(2, 2, 10.0, 20.0)) == [("WARNING", 0.0, "Écart de 2 jours depuis le relevé précédent (2024-03-01)")]
    assert chain(spark, st(1, 0, 0.0, 10.0, hours=10), st(2, 2, 10.0, 20.0, hours=9)) == []  # 47 hours are one day
    double = chain(spark, st(2, 0, 5.0, 99.0), st(1, 0, 0.0, 10.0), st(3, 1, 10.0, 1.0))
    assert double == [("ERROR", None, "2 lignes pour la même date 2024-03-01 00:00:00 (compte ambigu)")]
    assert chain(spark, st(1, 0, 0.0, 10.0, account=None), st(2, 1, 11.0, 1.0, account=None))[0][0] == "ERROR"
    assert chain(spark, st(1, 0, 0.0, 10.0), st(2, 1, 11.0, 1.0, account="Z")) == []


def test_no_activity_rows_are_not_chained(spark):
    na = {"account": "NA", "corr": "NA", "cur": "NA"}
    assert chain(spark, st(1, 0, 0.0, 0.0, **na), st(2, 1, 5.0, 0.0, **na)) == []


def test_statement_rules(spark):
    rows = [st(1, 0, 0.0, 10.0), st(2, 0, 0.0, 10.0, corr="NA", account="X"), st(3, 0, 0.0, 0.0, corr="NA", cur="NA", account="NA"), st(4, 0, 3.0, 3.0, corr="NA", cur="NA", account="NA"), st(5, 100, 0.0, 1.0, account="L")]
    df = spark.createDataFrame(rows, ST).withColumn("TotalMvtsCrediteurs", F.when(F.col("i") == 1, None).otherwise(F.col("TotalMvtsCrediteurs")))
    marked, found = validate_statements(df, order=["i"])
    assert [r._NC_row_conforme for r in marked.orderBy("i").collect()] == [False, False, True, False, False]
    by = {(r.Rule, r.NumCompte): r.Detail for r in found.collect()}
    assert by[("ARITHMETIC", "A")] == "Champ(s) non numérique(s)/manquant(s) : TotalMvtsCrediteurs"
    assert by[("NO_ACTIVITY_CONFORMITY", "X")] == "NA partielle : Devise, NumCompte non-NA alors que d'autres champs identifiants le sont"
    assert "SoldeDebutJournee, SoldeFinJournee" in by[("NO_ACTIVITY_CONFORMITY", "NA")] and by[("DATE_VALIDITY", "L")].startswith("DateFinJournee=2024-06-09 postérieure")


def test_continuity_doesnt_lower_conformity(spark):
    marked, found = validate_statements(spark.createDataFrame([st(1, 0, 0.0, 10.0), st(2, 1, 50.0, 60.0)], ST), order=["i"])
    assert all(r._NC_row_conforme for r in marked.collect()) and found.count() == 1
    one = quality.anomaly_counts(marked, found, "_NC_row_conforme").first()
    assert (one.n_anomalies_error, one.taux_conformite_pct) == (1, 100.0)


def test_witness(spark):
    df = spark.createDataFrame([st(1, 0, 0.0, 0.0, corr="na", cur="NA", account=" NA"), st(2, 0, 0.0, 1.0, corr="NA", cur="NA", account="NA")], ST)
    cols = StatementColumns()
    got = add_global_witness(df, [cols.correspondent, cols.currency, cols.account], list(cols.amounts), "w").orderBy("i").collect()
    assert [r.w for r in got] == ["NA", ""] and add_global_witness(df, ["absent"], [], "w").first().w == ""


@pytest.fixture()
def rated(spark):
    rows = [(1, "B1", "x", "OUTLIER", "NOISE"), (2, "B1", "x", "OUTLIER", "NOISE"), (3, "B1", "usd", "USD", "MAP"), (4, "B2", "y", "OUTLIER", "OUTLIER"), (5, None, "x", "OUTLIER", "NOISE"), (6, "B2", None, "OUTLIER", "OUTLIER"), (7, "B2", "USD", "USD", "CLAUDE"), (8, "B2", "NA", "NA", "NA")]
    return spark.createDataFrame(rows, "i int, RefBanque string, v string, o string, v_method string")


def test_quality_of_a_field(spark, rated):
    got = {(r.RefBanque, r.v): (r.Nombre_OUTLIERS, r.Ratio_OUTLIERS, r.Nombre_total_OUTLIERS, r.Nombre_total_CLEAN_VALUES, r.Nombre_total_LIGNES) for r in quality.outlier_stats(rated, "v", "o").collect()}
    assert got == {("B1", "x"): (2, 66.67, 2, 1, 3), ("B2", "y"): (1, 25.0, 2, 2, 4)}
    assert quality.outlier_stats(rated.drop("RefBanque"), "v", "o").where("v = 'x'").first().Ratio_OUTLIERS == 37.5
    one = quality.field_stats(rated, "v", "o").first()
    assert (one.n_rows, one.n_distinct_total, one.n_distinct_normalized, one.n_outlier_rows, one.taux_normalisation_pct, one.taux_outliers_pct) == (8, 5, 3, 5, 60.0, 62.5)
    new = quality.new_values(rated, "v", "o", ["i"]).first()
    assert tuple(new) == (4, 2, 2)  # y, the null value, USD by the resolver and NA
    split = quality.known_noise_split(rated, "v", "o").first()
    assert (split.known, split.new) == (1, 1)
    empty = quality.field_stats(rated.limit(0), "v", "o").first()
    assert (empty.n_rows, empty.taux_outliers_pct) == (0, 0.0)


def test_quality_of_a_run(spark, rated):
    df = rated.withColumn("_TX_row_conforme", F.col("i") != 3)
    found = spark.createDataFrame([("B1", "DATE_VALIDITY", "ERROR", "id"), ("B2", "T", "WARNING", "id"), (None, "DATE_VALIDITY", "ERROR", "id")], "RefBanque string, Rule string, Severity string, ref string")
    one = quality.run_indicators(df, ["o", "absent"]).first()
    assert (one.n_outlier_rows, one.taux_conformite_pct) == (6, 25.0)
    assert {r.champ: r.n for r in quality.outliers_by_field(df, {"f": "o"}, found).collect()} == {"f": 5, "DATE_VALIDITY": 2}
    assert {r.RefBanque: r.n for r in quality.outliers_by_bank(df, ["o"], found).collect()} == {"B1": 4, "B2": 2}  # rows and errors both count
    detail = quality.bank_detail({"f": (quality.outlier_stats(df, "v", "o"), "v")}, [(found, "ref")], {"f": "Champ"})
    assert {tuple(r) for r in detail.collect()} == {("B1", "Champ", "x", 2), ("B2", "Champ", "y", 1), ("B1", "DATE_VALIDITY", "id", 1)}
    assert [tuple(r) for r in quality.top_banks(detail, 1).collect()] == [("B1", 3, 75.0)]
    rows = quality.field_synthesis(quality.outliers_by_field(df, {"f": "o"}, found), ["a", "b"], {"f": "a"}).collect()
    assert [(r.label, r.n, r.pct) for r in rows] == [("a", 5, 71.4), ("b", 0, 0.0)]
    news = [quality.new_values(df, "v", "o", ["i"])] * 2
    assert quality.mail_counters(news, 3).first().n_new_distinct == 8
    assert quality.mean_rate([quality.field_stats(df, "v", "o")]).first()[0] == 60.0
    assert {r.Rule: r.dominant for r in quality.dominance(8, found).collect()} == {"DATE_VALIDITY": True, "T": False}
