"""Declarations derived from star-schema tables in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def dirty(number: str, values: list[str | None]) -> str:
    """The values in turn by a number modulo their count."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {arms} END"


CURRENCIES = ["usd", "840", "840.0", "euros", "USD (dollar)", "E.U.R", "USDX", "XXX", "@@", None, "", "NA", " mru ", "978", "GBP", "dollars"]
MESSAGES = ["MT 103", "mt103", "103", "12345", "1,5", "pacs.008", "MT 202 COV", "NULL", "zzz", None, "NA", "PACS.004", " mt 104 "]
MODES = ["CD", "c d", "tr", "TL", "SWIFT", "??", None, "NA", "rd ", ""]
NATURES = ["IMPORT", "Importation de biens", "123-SALAIRES", "divers", "12345", "Ahmed Ould Sidi", "NA", None, "", "fret", "VOYAGES", "autre chose"]
COUNTRIES = ["france", "FR", "Mauritanie", "NA", None, "12", "casablanca centre", "NOGAS", "noas", "Espagne", "US", "inconnu xyz", "maroc"]
PRODUCTS = ["Riz", "gasoil", "DIESEL", "NA", None, "véhicules", "TEST", "autre produit"]
BANKS = ["Bred  Banque", "BRED BANQUE POPULAIRE", "bred banque populaire", "Natixis Paris", "NA", None, "autre banque", "ATTIJARI"]
NAMES = ["SOCIETE ALPHA SARL", "Mohamed Ould Ahmed", "ETS Mohamed Salem", "ETS DU NORD", "H.M Trading", "12345", None, "SOMELEC NOUAKCHOTT", "Beta.Gamma", "ALI ET FILS", "NA", "x"]
IDS = ["00000017", "11111111", "1234567", "00-00-00-25", None, "abc"]
TEXT_NUMBERS = ["1,5", " 12 ", "1e5", "1d", "NaN", "1.234,56", "NA", None, "", "-3.", ".5", "+7", "inf", "36.5"]
TEXT_DATES = ["2024-01-02", "25/12/2024", "03/04/2024", "NA", None, "2024-13-01", "20240102", "2024-01-02 10:11:12", "12", "2024"]

TX = f"""
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 11 = 0 THEN 'NA' WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('REF', CAST(o_orderkey AS STRING)) END AS ReferenceTransaction,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE concat('BANK', lpad(CAST(o_custkey % 12 AS STRING), 2, '0')) END AS RefBanque,
  {dirty("o_orderkey", CURRENCIES)} AS Devise,
  {dirty("(o_orderkey + o_custkey)", MESSAGES)} AS TypeSwfit,
  {dirty("(o_orderkey + 2 * o_custkey)", MODES)} AS ModeReglement,
  {dirty("(o_orderkey + 3 * o_custkey)", NATURES)} AS NatureEconomique,
  {dirty("(o_orderkey + 5 * o_custkey)", COUNTRIES)} AS Pays,
  {dirty("(o_orderkey + o_custkey)", PRODUCTS)} AS Produit,
  {dirty("o_custkey", BANKS)} AS NomCorrespondant,
  {dirty("(o_orderkey + o_custkey)", NAMES)} AS NomDonneurOrdre,
  {dirty("o_custkey", IDS)} AS NifNni,
  CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 2 = 0 THEN 0.0 WHEN o_orderkey % 17 = 0 THEN -o_totalprice WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS MontantTransaction,
  {dirty("o_custkey", TEXT_NUMBERS)} AS TauxDeChange,
  o_orderdate AS DateTransaction,
  CASE WHEN o_orderkey % 19 = 0 THEN o_orderdate WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN o_orderdate - INTERVAL 3 DAY ELSE o_orderdate + INTERVAL 1 DAY END AS dtCr
FROM {{orders}}"""

DUE = """
SELECT l_orderkey * 10 + l_linenumber AS row_id, concat('LC', CAST(l_orderkey AS STRING)) AS NumCredoc, concat('BANK', CAST(l_suppkey % 7 AS STRING)) AS RefBanque,
  CASE WHEN l_orderkey % 13 = 0 THEN -l_extendedprice WHEN l_orderkey % 31 = 0 THEN 0.0 WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_extendedprice END AS MontantEcheance,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_shipdate END AS DateEcheance, CASE WHEN l_linenumber = 3 THEN l_shipdate ELSE l_shipdate - INTERVAL 10 DAY END AS dtCr
FROM {lineitem}"""

STATEMENTS = """
SELECT o_orderkey AS row_id, concat('BANK', CAST(o_custkey % 5 AS STRING)) AS RefBanque,
  CASE WHEN o_orderkey % 43 = 0 OR o_orderkey % 47 = 0 THEN 'NA' ELSE concat('CORR', CAST(o_custkey % 9 AS STRING)) END AS NomCorrespondant,
  CASE WHEN o_orderkey % 43 = 0 THEN 'NA' ELSE 'USD' END AS Devise, CASE WHEN o_orderkey % 43 = 0 THEN 'NA' WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('ACC', CAST(o_custkey AS STRING)) END AS NumCompte,
  CASE WHEN o_orderkey % 86 = 0 THEN 0.0 ELSE CAST(o_orderkey % 10 AS DOUBLE) * 100.0 END AS SoldeDebutJournee,
  CASE WHEN o_orderkey % 86 = 0 THEN 0.0 ELSE CAST(o_orderkey % 4 AS DOUBLE) * 25.0 END AS TotalMvtsDebiteursJournee,
  CASE WHEN o_orderkey % 86 = 0 THEN 0.0 WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS DOUBLE) * 50.0 END AS TotalMvtsCrediteurs,
  CASE WHEN o_orderkey % 86 = 0 THEN 0.0 WHEN o_orderkey % 15 = 0 THEN CAST(o_orderkey % 10 AS DOUBLE) * 100.0 + 0.02 ELSE CAST(o_orderkey % 10 AS DOUBLE) * 100.0 + CAST(o_orderkey % 6 AS DOUBLE) * 50.0 - CAST(o_orderkey % 4 AS DOUBLE) * 25.0 END AS SoldeFinJournee,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 7 < 2 THEN date_trunc('year', o_orderdate) ELSE o_orderdate END AS DateFinJournee,
  CASE WHEN o_orderkey % 37 = 0 THEN o_orderdate - INTERVAL 2 DAY WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS dtCr
FROM {orders}"""

BASE = """
SELECT c_custkey AS place, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey AS STRING) ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END AS NIF,
  CASE c_custkey WHEN 2 THEN 'Société Alpha S.A.R.L' WHEN 3 THEN 'HM TRADING' WHEN 5 THEN 'BETA GAMMA' ELSE c_name END AS RAISON_SOCIALE, 'SARL' AS FORME_JURIDIQUE
FROM {customer}"""

TEXTS = {"tx": TX, "due": DUE, "statements": STATEMENTS, "base": BASE}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = TEXTS[name]
    used = [t for t in ("orders", "lineitem", "customer") if "{" + t + "}" in text]
    return spark.sql(text, **tables(spark, sf_dir, *used))


def cte(name: str) -> str:
    """The view as a DuckDB common table expression."""
    text = TEXTS[name]
    for t in ("orders", "lineitem", "customer"):
        text = text.replace("{" + t + "}", t)
    return f"{name} AS ({text})"
