from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqloom.functions import parse, similarity, text


def applied(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_cleaners(spark):
    assert applied(spark, text.clean_currency, [" usd ", "840.0", "e u r", None, " ", "NaN", "1 000"]) == ["USD", "840", "EUR", "", "", "", "1000"]
    assert applied(spark, text.clean_product, ["  Véhicules  neufs", "Œuf", None]) == ["VEHICULES NEUFS", "ŒUF", ""]
    assert applied(spark, text.clean_country, ["Côte d'Ivoire", "12/03/2024 France", "MAROC - 2024-01-02", "null", "L’Île"]) == ["COTE D IVOIRE", "FRANCE", "MAROC -", "", "L ILE"]
    assert applied(spark, text.clean_nature, ["123-Importation de biens", "AB12 frais é", "a b c", "None"]) == ["IMPORTATION DE BIENS", "FRAIS", "", ""]
    assert applied(spark, text.clean_correspondent, ["  Bred \t Banque ", "none"]) == ["Bred Banque", ""]
    assert applied(spark, text.compact_key, [" mt 103 +", "nan", None]) == ["MT103+", "", ""]


def test_clean_label_rewrites_names(spark):
    given_ = ["MED O/ AHMED", "FATIMA Mt/ HMD", "H.M Trading", "Beder.Salam", "A B C SARL", "x_x000D_y\\n", "10 USD (total)", "--É--à--", None, "null", "S.A.R.L -"]
    want = ["MED OULD AHMED", "FATIMA MINT HMD", "HM TRADING", "BEDER SALAM", "ABC SARL", "XY", "10 TOTAL", "E-A", "", "", "SARL"]
    assert applied(spark, text.clean_label, given_) == want


def test_tax_ids(spark):
    assert applied(spark, text.tax_id_padded, ["12-34", None, "123456789"]) == ["00001234", "00000000", "123456789"]
    assert applied(spark, text.tax_id_valid, ["12345678", "11111111", "1234567", ""]) == [True, False, False, False]


def test_display(spark):
    assert applied(spark, lambda c: text.grouped_int(c.cast("int")), ["1234567", "12"]) == ["1 234 567", "12"]
    assert applied(spark, lambda c: text.percent_text(c.cast("double")), ["12.34"]) == ["12,3 %"]
    cell = applied(spark, text.report_cell, ["a_x000D_ b\n c", "x" * 60, "word " * 40])
    assert cell[0] == "a b c" and cell[1] == "x" * 28 + " " + "x" * 28 + " " + "x" * 4 and len(cell[2]) <= 91 and cell[2].endswith("…")
    assert text.duration_text(125) == "02:05"


NUMBERS = ["1,5", " 12 ", "1e5", "1d", "NaN", "1,234.56", "NA", None, "", "-3.", ".5", "+7", "inf", "-Infinity", "1_000", "0x1"]


def test_numbers(spark):
    want = [1.5, 12.0, 1e5, None, None, None, None, None, None, -3.0, 0.5, 7.0, float("inf"), float("-inf"), None, None]
    assert applied(spark, parse.number_from_text, NUMBERS) == want


def test_dates_month_first_then_day_first(spark):
    values = ["2024-01-02", "25/12/2024", "03/04/2024", "NA", None, "2024-13-01", "20240102", "2024-01-02 10:11:12", "12", "2024", "01-02-2024", "Jan 5 2024", "none"]
    day = lambda m, d, *t: datetime(2024, m, d, *t)
    want = [day(1, 2), day(12, 25), day(3, 4), None, None, None, day(1, 2), day(1, 2, 10, 11, 12), None, day(1, 1), day(1, 2), day(1, 5), None]
    assert applied(spark, parse.time_from_text, values) == want


def test_number_text_is_pythons(spark):
    values = [100000000.0, 0.1, -2.5, 12.0, 1234.56]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    assert [r.o for r in df.select("i", parse.number_text(F.col("v")).alias("o")).orderBy("i").collect()] == [str(v) for v in values]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", max_size=14), st.text("ab c", max_size=14))
def test_lcs_and_bounds(a, b):
    assert similarity.lcs_length(a, b) == slow_lcs(a, b)
    score = similarity.weighted_ratio(a, b)
    assert 0 <= score <= 100 and score <= similarity.upper_bound(a, b) + 1e-9
    assert score == pytest.approx(similarity.weighted_ratio(b, a))


def test_known_similarities():
    assert similarity.ratio("this is a test", "this is a test!") == pytest.approx(96.55, abs=0.01)
    assert similarity.partial_ratio("this is a test", "this is a test!") == 100
    assert similarity.token_ratio("fuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert similarity.weighted_ratio("SOCIETE ALPHA SARL", "ALPHA SOCIETE SARL") == 95
    assert similarity.weighted_ratio("", "x") == 0
    assert similarity.top_matches("abc", ["abd", "abc", "zzz", "abc"], 2) == [(1, 100.0), (3, 100.0)]
