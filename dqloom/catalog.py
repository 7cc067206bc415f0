"""The registered queries: each operator over declarations derived from the test tables, with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dictionaries as words
from .functions import parse, text
from .operators import fields, memory, quality
from .operators.cascade import attach, distinct_values, pairs
from .operators.chaining import temporal_continuity
from .operators.no_activity import add_global_witness, apply_country_rule, apply_na_rule
from .operators.similarity_join import best_names, first_token_hit, nearest_by_edits
from .operators.validation import StatementColumns, TransactionColumns, anomalies, annotate, due_checks, statement_checks, transaction_checks, validate_statements, validate_transactions
from .sources import sinks, tables
from .views import TEXT_DATES, cte, dirty, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CODES = ["EUR", "GBP", "JPY", "MRU", "USD"]
NUMBERS = {"840": "USD", "978": "EUR"}
MEMORY = {"@@": "XOF"}
#: Names and towns that the inputs below contain; real lists come from dictionary files.
NAMES = ["AHMED", "MOHAMED", "SALEM"]
TOWNS = {"casablanca": "MA", "paris": "FR", "shanghai": "CN"}
COUNTRY_NAMES = {"france": "FR", "espagne": "ES", "maroc": "MA", "mauritanie": "MR"}
COUNTRY_CODES = ["ES", "FR", "MA", "MR", "US"]
BANK_NAMES = {"Natixis Paris": "NATIXIS", "ATTIJARI": "ATTIJARI BANK", "Bred Banque": "BRED BANQUE POPULAIRE"}
CURRENCY = {"codes": CODES, "numbers": NUMBERS, "memory": MEMORY}
COUNTRY = {"names": COUNTRY_NAMES, "codes": COUNTRY_CODES, "fuzzy": None, "address_words": TOWNS}


def query(sql: str | None = None):
    """Register a function as a query under its name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def table_of(entries: dict[str, str]) -> str:
    return "(VALUES " + ", ".join(f"({listed([k])}, {listed([v])})" for k, v in entries.items()) + ") t(k, v)"


def found(entries: dict[str, str], key: str) -> str:
    return f"(SELECT v FROM {table_of(entries)} WHERE k = {key})"


def rows(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def counted(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


# ---- scans ----------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def scan_projection(spark, sf_dir):
    return tables.scan(rows(spark, sf_dir, "lineitem", "*"), ["l_orderkey", "l_quantity"])


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'")
def initial_since(spark, sf_dir):
    return tables.scan(rows(spark, sf_dir, "orders", "*"), ["o_orderkey"], "o_orderdate", "1996-01-01 00:00:00")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01 00:00:00'")
def delta_since_watermark(spark, sf_dir):
    return tables.scan_delta(rows(spark, sf_dir, "orders", "*"), "o_orderdate", "1997-06-01 00:00:00", ["o_orderkey"])


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events")
def max_watermark(spark, sf_dir):
    df = rows(spark, sf_dir, "events", "ts")
    return df.agg(F.date_format(F.max(parse.to_time(df, "ts")), "yyyy-MM-dd HH:mm:ss").alias("latest"))


@query("SELECT count(*) AS n_rows, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders")
def volume_probe(spark, sf_dir):
    one = tables.probe(rows(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate")
    return one.select("n_rows", F.date_format("min_created", "yyyy-MM-dd").alias("first_day"), F.date_format("max_created", "yyyy-MM-dd").alias("last_day"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_rows FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def volume_probe_by_year(spark, sf_dir):
    return tables.probe_by_year(rows(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def ad_hoc_query(spark, sf_dir):
    return tables.guarded_sql(spark, "SELECT o_orderstatus AS status, count(*) AS n FROM {source} GROUP BY o_orderstatus", source=rows(spark, sf_dir, "orders", "*"))


@query(
    r"""SELECT lpad_nif AS nif, count(*) AS n, bool_and(length(lpad_nif) = 8 AND length(replace(lpad_nif, substr(lpad_nif, 1, 1), '')) > 0) AS valid FROM (
SELECT CASE WHEN length(d) >= 8 THEN d ELSE lpad(d, 8, '0') END AS lpad_nif FROM (SELECT regexp_replace(coalesce(NifNni, ''), '\D', '', 'g') AS d FROM (WITH """
    + cte("tx")
    + " SELECT NifNni FROM tx))) GROUP BY 1"
)
def tax_ids(spark, sf_dir):
    df = view(spark, sf_dir, "tx").select(text.tax_id_padded(F.col("NifNni")).alias("nif"))
    return df.groupBy("nif").agg(F.count("*").alias("n"), F.bool_and(text.tax_id_valid(F.col("nif"))).alias("valid"))


# ---- cascades -------------------------------------------------------------------------------------------------


def resolved_rows(spark, sf_dir, kind: str, raw: str, **options) -> DataFrame:
    """raw, value and method of the rows, counted."""
    df = view(spark, sf_dir, "tx").select(raw)
    found_ = fields.RESOLVERS[kind](distinct_values(df, raw), raw, **options)
    return counted(attach(df, found_, [raw], "value", "method"), raw, "value", "method")


def cascade_sql(raw: str, clean: str, arms: list[tuple[str, str, str]], otherwise: str | None = "'OUTLIER'", source: str = "tx") -> str:
    """Value and method of the distinct values of raw: arms are (condition, value, method), the first that holds counts."""
    other = otherwise or "NULL"
    value = " ".join(f"WHEN {c} THEN {v}" for c, v, _ in arms)
    method = " ".join(f"WHEN {c} THEN {m}" for c, _, m in arms)
    return f"""WITH {cte(source)}, c AS (SELECT r, {clean} AS clean FROM (SELECT DISTINCT {raw} AS r FROM {source})),
res AS (SELECT r, CASE WHEN r IS NULL THEN NULL {value} ELSE {other} END AS value, CASE WHEN r IS NULL THEN NULL {method} ELSE {other} END AS method FROM c)
SELECT {raw}, value, method, count(*) AS n FROM {source} JOIN res ON {raw} IS NOT DISTINCT FROM r GROUP BY 1, 2, 3"""


def _table_arm(entries: dict[str, str], key: str, method: str, also: str = "TRUE") -> tuple[str, str, str]:
    return f"{also} AND {key} IN ({listed(entries)})", found(entries, key), f"'{method}'"


SAME = {c: c for c in CODES}
_bare = "regexp_replace(clean, '[^A-Za-z0-9]', '', 'g')"
_start = f"CASE WHEN length({_bare}) > 3 THEN substr({_bare}, 1, 3) ELSE '' END"
CURRENCY_ARMS = [
    _table_arm(MEMORY, "r", "WARM"), ("clean = ''", "NULL", "NULL"), (f"clean IN ({listed(words.CURRENCY_NOISE)})", "'OUTLIER'", "'NOISE'"),
    _table_arm(SAME, "clean", "MAP"), _table_arm(NUMBERS, "clean", "NUM", "length(clean) = 3"), _table_arm(words.CURRENCY_ALIASES, "clean", "ALIAS"),
    *[_table_arm(t, k, "STRIP") for k in ("trim(split_part(clean, '(', 1))", _bare, _start) for t in (SAME, words.CURRENCY_ALIASES)],
]
CURRENCY_CLEAN = r"upper(regexp_replace(regexp_replace(trim(r), '\.0+$', ''), '\s+', '', 'g'))"


@query(cascade_sql("Devise", CURRENCY_CLEAN, CURRENCY_ARMS))
def currency_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "currency", "Devise", **CURRENCY)


_compact = {c.upper().replace(" ", ""): c for c in words.MESSAGE_TYPES_OUT}
COMPACT = r"CASE WHEN lower(trim(r)) IN ('nan', 'none', 'null') THEN '' ELSE upper(regexp_replace(r, '\s+', '', 'g')) END"
MESSAGE_ARMS = [("clean = ''", "NULL", "NULL"), (f"clean IN ({listed(words.MESSAGE_NOISE)}) OR regexp_matches(clean, '[0-9,.]{{5,}}|,')", "'OUTLIER'", "'NOISE'"), _table_arm(_compact, "clean", "MAP"), _table_arm(_compact, "concat('MT', clean)", "PREFIX", "regexp_full_match(clean, '[0-9]{3}')")]
MESSAGE_ARMS[1] = (MESSAGE_ARMS[1][0].replace("{{", "{").replace("}}", "}"), *MESSAGE_ARMS[1][1:])


@query(cascade_sql("TypeSwfit", COMPACT, MESSAGE_ARMS))
def swift_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "message_type", "TypeSwfit", flow="OUT")


@query(cascade_sql("ModeReglement", COMPACT, [("clean = ''", "NULL", "NULL"), (f"clean IN ({listed(n.upper() for n in words.PAYMENT_NOISE)})", "'OUTLIER'", "'NOISE'"), _table_arm({m: m for m in words.PAYMENT_MODES}, "clean", "MAP"), _table_arm(words.PAYMENT_ALIASES, "clean", "ALIAS")]))
def payment_mode_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "payment_mode", "ModeReglement")


_labels = {x: x for x in words.flatten_categories(words.NATURES)}
NATURE_CLEAN = r"array_to_string(list_filter(string_split(trim(regexp_replace(trim(regexp_replace(upper(r), '[^A-Z0-9]+', ' ', 'g')), '^\d{1,5}[-\s]+', '')), ' '), lambda w: length(w) >= 2 AND NOT regexp_full_match(w, '[0-9A-Z]{1,3}[0-9]+[0-9A-Z]*')), ' ')"
_known = f"len(list_filter(string_split(clean, ' '), lambda w: w IN ({listed(NAMES)})))"
NATURE_ARMS = [
    ("upper(trim(r)) IN ('', 'NAN', 'NONE', 'NULL')", "NULL", "NULL"), ("upper(trim(r)) = 'NA'", "'OUTLIER'", "'OUTLIER'"),
    (f"clean = '' OR length(clean) <= 1 OR regexp_full_match(clean, '[0-9]+') OR clean IN ({listed(words.NATURE_HEADERS)}) OR (len(string_split(clean, ' ')) >= 2 AND {_known} >= greatest(1, len(string_split(clean, ' ')) // 2))", "'OUTLIER'", "'NOISE'"),
    _table_arm(_labels, "clean", "MAP"), _table_arm({k: v for k, v in words.NATURE_DIRECT.items() if v}, "clean", "MAP"),
    (f"clean IN ({listed(k for k, v in words.NATURE_DIRECT.items() if v is None)})", "'OUTLIER'", "'NOISE'"),
]


@query(cascade_sql("NatureEconomique", NATURE_CLEAN, NATURE_ARMS, None))
def nature_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "nature", "NatureEconomique", names=NAMES)


_targets = {v.upper(): v for v in BANK_NAMES.values()}


@query(cascade_sql("NomCorrespondant", r"trim(regexp_replace(r, '\s+', ' ', 'g'))", [("clean = ''", "NULL", "NULL"), _table_arm(_targets, "upper(clean)", "MAP_CIBLE"), _table_arm(BANK_NAMES, "clean", "MAP"), ("upper(clean) = 'NA'", "'OUTLIER'", "'OUTLIER'")], None))
def correspondent_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "correspondent", "NomCorrespondant", mapping=BANK_NAMES)


@query(cascade_sql("Produit", "upper(strip_accents(trim(r)))", [("clean = ''", "NULL", "NULL"), ("clean = 'NA'", "'OUTLIER'", "'OUTLIER'"), (f"clean IN ({listed(words.PRODUCT_NOISE)})", "'OUTLIER'", "'NOISE'"), _table_arm(words.PRODUCT_ALIASES, "clean", "MAP"), _table_arm({x: x for x in words.flatten_categories(words.PRODUCTS)}, "clean", "MAP_CIBLE")], None))
def product_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "product", "Produit")


_names = {k: v for k, v in COUNTRY_NAMES.items()}
_not_country = words.NOT_A_COUNTRY.replace("NA(?!MIBI)", "NA")
_address = sorted(TOWNS.items(), key=lambda kv: -len(kv[0]))
COUNTRY_ARMS = [
    ("clean = ''", "NULL", "NULL"), (f"regexp_matches(clean, '{_not_country}') OR regexp_full_match(clean, '[0-9]+')", "'OUTLIER'", "'OUTLIER'"), _table_arm(_names, "lower(clean)", "MAP"),
    _table_arm({c: c for c in COUNTRY_CODES}, "clean", "MAP", "length(clean) = 2"), *[(f"contains(lower(clean), '{k}')", f"'{v}'", "'ADDR'") for k, v in _address],
]


@query(cascade_sql("Pays", "upper(trim(r))", COUNTRY_ARMS, "'check'"))
def country_deterministic(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "country", "Pays", **COUNTRY)


# Cleaned forms of the names in the view, for the oracle: clean_label has no SQL form.
_cleaned = {"SOCIETE ALPHA SARL": "SOCIETE ALPHA SARL", "Mohamed Ould Ahmed": "MOHAMED OULD AHMED", "ETS Mohamed Salem": "ETS MOHAMED SALEM", "ETS DU NORD": "ETS DU NORD", "H.M Trading": "HM TRADING", "12345": "12345", "SOMELEC NOUAKCHOTT": "SOMELEC NOUAKCHOTT", "Beta.Gamma": "BETA GAMMA", "ALI ET FILS": "ALI ET FILS", "NA": "NA", "x": "X"}
_company = "(^|[^A-Z0-9_])(" + "|".join(sorted(words.COMPANY_WORDS, key=len, reverse=True)) + ")([^A-Z0-9_]|$)"
_has_name = f"len(list_filter(string_split({{}}, ' '), lambda w: w IN ({listed(NAMES)}))) > 0"
_rest = "trim(regexp_replace(clean, '^(ETS|ETB|ETABLISSEMENTS?)([^A-Z0-9_]|$)\\s*', ''))"
_ets = "regexp_matches(clean, '^(ETS|ETB|ETABLISSEMENTS?)([^A-Z0-9_]|$)')"
LOCAL_ARMS = [
    (f"NOT regexp_matches(clean, '{_company}') AND NOT regexp_matches(clean, '(^| )ET (FRERES|FILS)( |$)') AND len(string_split(clean, ' ')) >= 2 AND {_has_name.format('clean')}", "clean", "'PARTICULIER'"),
    (f"{_ets} AND {_rest} <> '' AND {_has_name.format(_rest)} AND NOT regexp_matches({_rest}, '{_company}')", "clean", "'ETS_PERSONNEL'"), (_ets, "'OUTLIER'", "'ETS_OUTLIER'"),
]


@query(cascade_sql("NomDonneurOrdre", found(_cleaned, "r"), LOCAL_ARMS, None))
def local_classifier(spark, sf_dir):
    from .operators.cascade import resolve

    df = view(spark, sf_dir, "tx").select("NomDonneurOrdre")
    values = distinct_values(df, "NomDonneurOrdre").withColumn("clean", text.clean_label(F.col("NomDonneurOrdre")))
    found_ = resolve(values, fields.local_steps(F.col("clean"), NAMES), otherwise=None)
    return counted(attach(df, found_, ["NomDonneurOrdre"], "value", "method"), "NomDonneurOrdre", "value", "method")


@query(
    rf"""WITH {cte("tx")}, {cte("base")}, c AS (SELECT DISTINCT NomDonneurOrdre AS r, NifNni AS nif, {found(_cleaned, "NomDonneurOrdre")} AS clean, regexp_replace(coalesce(NifNni, ''), '\D', '', 'g') AS d FROM tx WHERE NomDonneurOrdre IS NOT NULL),
b AS (SELECT CASE WHEN length(NIF) >= 8 THEN NIF ELSE lpad(NIF, 8, '0') END AS id, arg_min(RAISON_SOCIALE, place) AS v FROM base GROUP BY 1),
bare AS (SELECT regexp_replace(CASE RAISON_SOCIALE WHEN 'Société Alpha S.A.R.L' THEN 'SOCIETE ALPHA SARL' ELSE upper(RAISON_SOCIALE) END, '[^A-Z0-9]', '', 'g') AS k, arg_min(RAISON_SOCIALE, place) AS v FROM base GROUP BY 1)
SELECT r AS NomDonneurOrdre, nif AS NifNni, CASE WHEN b.v IS NOT NULL THEN b.v ELSE bare.v END AS value, CASE WHEN b.v IS NOT NULL THEN 'NIF_EXACT' WHEN bare.v IS NOT NULL THEN 'DGI_EXACT_NORM' END AS method
FROM c LEFT JOIN b ON b.id = d AND length(d) = 8 AND length(replace(d, substr(d, 1, 1), '')) > 0 LEFT JOIN bare ON bare.k = regexp_replace(clean, '[^A-Z0-9]', '', 'g')"""
)
def entity_exact_stages(spark, sf_dir):
    from .operators.cascade import Table, resolve

    df = view(spark, sf_dir, "tx").select("NomDonneurOrdre", "NifNni")
    tax = fields.tax_tables(view(spark, sf_dir, "base"), "place")
    values = distinct_values(df, "NomDonneurOrdre", "NifNni").withColumns({"clean": text.clean_label(F.col("NomDonneurOrdre")), "nif_": text.tax_id(F.col("NifNni"))})
    steps = [Table("NIF_EXACT", tax["id"], F.when(text.tax_id_valid(F.col("nif_")), F.col("nif_"))), Table("DGI_EXACT_NORM", tax["bare"], text.hyper_normalised(F.col("clean")))]
    return resolve(values, steps, otherwise=None).select("NomDonneurOrdre", "NifNni", "value", "method")


@query()
def local_entity_cascade(spark, sf_dir):
    df = view(spark, sf_dir, "tx").select("NomDonneurOrdre", "NifNni")
    entities = spark.createDataFrame([(0, "SOMELEC", "Societe Mauritanienne d'Electricite"), (1, "SNIM", "Societe Nationale Industrielle et Miniere")], ["place", "Short Name", "Raison social - Public Ent"])
    out, _ = fields.local_entity(distinct_values(df, "NomDonneurOrdre", "NifNni"), "NomDonneurOrdre", "NifNni", view(spark, sf_dir, "base"), entities, names=NAMES)
    return out.select("NomDonneurOrdre", "NifNni", "value", "method")


@query()
def foreign_entity_cascade(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "foreign_entity", "NomDonneurOrdre", mapping={"HM TRADING": "H.M. TRADING LTD"})


@query(f"WITH {cte('tx')}, c AS (SELECT DISTINCT {found(_cleaned, 'NomDonneurOrdre')} AS label FROM tx WHERE NomDonneurOrdre IS NOT NULL) SELECT label, 'SOMELEC' AS v FROM c WHERE list_contains(string_split(label, ' '), 'SOMELEC')")
def public_entity_token(spark, sf_dir):
    labels = distinct_values(view(spark, sf_dir, "tx"), "NomDonneurOrdre").select(text.clean_label(F.col("NomDonneurOrdre")).alias("label")).distinct()
    return first_token_hit(labels, "label", pairs(spark, {"SOMELEC": "SOMELEC", "SNIM": "SNIM"}))


@query(
    f"""WITH {cte('tx')}, c AS (SELECT DISTINCT upper(NomCorrespondant) AS label FROM tx WHERE NomCorrespondant IS NOT NULL), names(name, place) AS (VALUES {", ".join(f"('{v}', {i})" for i, v in enumerate(["BRED BANQUE POPULAIRE", "NATIXIS", "ATTIJARI BANK", "SOCIETE GENERALE", "BNP PARIBAS"]))}),
r AS (SELECT label, name, levenshtein(label, name) AS distance, row_number() OVER (PARTITION BY label ORDER BY levenshtein(label, name), place) AS rank FROM c, names)
SELECT label, CAST(rank AS INT) AS rank, name, CAST(distance AS INT) AS distance FROM r WHERE rank <= 3"""
)
def similarity_topk_levenshtein(spark, sf_dir):
    labels = distinct_values(view(spark, sf_dir, "tx"), "NomCorrespondant").select(F.upper("NomCorrespondant").alias("label")).distinct()
    names = spark.createDataFrame([(v, i) for i, v in enumerate(["BRED BANQUE POPULAIRE", "NATIXIS", "ATTIJARI BANK", "SOCIETE GENERALE", "BNP PARIBAS"])], "name string, place long")
    return nearest_by_edits(labels, names)


@query()
def similarity_topk_wratio(spark, sf_dir):
    labels = distinct_values(view(spark, sf_dir, "tx"), "NomDonneurOrdre").select(text.clean_label(F.col("NomDonneurOrdre")).alias("label")).where("label <> ''").distinct()
    return best_names(labels, fields.tax_tables(view(spark, sf_dir, "base"), "place")["names"].select("name", F.col("place").cast("bigint").alias("place")))


@query()
def country_fuzzy(spark, sf_dir):
    return resolved_rows(spark, sf_dir, "country", "Pays")


# ---- no-activity rules ----------------------------------------------------------------------------------------


def currency_rows(spark, sf_dir) -> DataFrame:
    df = view(spark, sf_dir, "tx")
    return attach(df, fields.currency(distinct_values(df, "Devise"), "Devise", **CURRENCY), ["Devise"], "Devise_Norm", "Devise_method")


def ruled(spark, sf_dir) -> DataFrame:
    return apply_na_rule(currency_rows(spark, sf_dir), "Devise", "ReferenceTransaction", "Devise_Norm", "Devise_method")


def currency_cte(extra: str = "") -> str:
    value = " ".join(f"WHEN {c} THEN {v}" for c, v, _ in CURRENCY_ARMS)
    method = " ".join(f"WHEN {c} THEN {m}" for c, _, m in CURRENCY_ARMS)
    return f"""WITH {cte('tx')}, c AS (SELECT r, {CURRENCY_CLEAN} AS clean FROM (SELECT DISTINCT Devise AS r FROM tx)),
res AS (SELECT r, CASE WHEN r IS NULL THEN NULL {value} ELSE 'OUTLIER' END AS v, CASE WHEN r IS NULL THEN NULL {method} ELSE 'OUTLIER' END AS m FROM c),
cur AS (SELECT tx.*, v, m, upper(trim(coalesce(Devise, ''))) AS f, upper(trim(coalesce(ReferenceTransaction, ''))) AS w FROM tx JOIN res ON Devise IS NOT DISTINCT FROM r),
rul AS (SELECT *, CASE WHEN f = 'NA' AND w = 'NA' THEN 'NA' WHEN f IN ('NA', '', 'NAN', 'NONE', 'NULL') OR v = 'OUTLIER' THEN 'OUTLIER' ELSE v END AS Devise_Norm,
  CASE WHEN f = 'NA' AND w = 'NA' THEN 'NA' WHEN f IN ('NA', '', 'NAN', 'NONE', 'NULL') THEN 'OUTLIER' WHEN v = 'OUTLIER' THEN coalesce(nullif(m, ''), 'OUTLIER') ELSE m END AS Devise_method FROM cur){extra}
"""


@query(currency_cte() + "SELECT Devise, Devise_Norm, Devise_method, count(*) AS n FROM rul GROUP BY 1, 2, 3")
def na_rule(spark, sf_dir):
    return counted(ruled(spark, sf_dir), "Devise", "Devise_Norm", "Devise_method")


_blank = "lower(trim(coalesce(ReferenceTransaction, ''))) IN ('na', 'nan', 'none', 'null', '', 'string')"
_p = "lower(trim(coalesce(Pays, '')))"


@query(
    f"""WITH {cte('tx')}, c AS (SELECT r, upper(trim(r)) AS clean FROM (SELECT DISTINCT Pays AS r FROM tx)),
res AS (SELECT r, CASE WHEN r IS NULL THEN NULL {" ".join(f"WHEN {c} THEN {v}" for c, v, _ in COUNTRY_ARMS)} ELSE 'check' END AS v, CASE WHEN r IS NULL THEN NULL {" ".join(f"WHEN {c} THEN {m}" for c, _, m in COUNTRY_ARMS)} ELSE 'check' END AS m FROM c)
SELECT Pays, value, method, count(*) AS n FROM (SELECT Pays,
  CASE WHEN {_p} IN ('', 'nan', 'none', 'null', 'na', 'noas', 'naos') AND {_blank} THEN 'NoAs' WHEN {_p} = 'na' THEN 'NA' WHEN {_p} IN ('', 'nan', 'none', 'null', 'noas', 'naos') OR v = 'OUTLIER' THEN 'OUTLIER' ELSE v END AS value,
  CASE WHEN {_p} IN ('', 'nan', 'none', 'null', 'na', 'noas', 'naos') AND {_blank} THEN 'NoAs' WHEN {_p} = 'na' THEN 'MAP' WHEN {_p} IN ('', 'nan', 'none', 'null', 'noas', 'naos') OR v = 'OUTLIER' THEN 'OUTLIER' ELSE m END AS method
FROM tx JOIN res ON Pays IS NOT DISTINCT FROM r) GROUP BY 1, 2, 3"""
)
def country_na_rule(spark, sf_dir):
    df = view(spark, sf_dir, "tx").select("Pays", "ReferenceTransaction")
    out = attach(df, fields.country(distinct_values(df, "Pays"), "Pays", **COUNTRY), ["Pays"], "value", "method")
    return counted(apply_country_rule(out, "Pays", "ReferenceTransaction", "value", "method"), "Pays", "value", "method")


STMT = StatementColumns()


@query(f"WITH {cte('statements')} SELECT row_id, CASE WHEN NomCorrespondant = 'NA' AND Devise = 'NA' AND NumCompte = 'NA' AND abs(SoldeDebutJournee) <= 1e-9 AND abs(TotalMvtsDebiteursJournee) <= 1e-9 AND abs(TotalMvtsCrediteurs) <= 1e-9 AND abs(SoldeFinJournee) <= 1e-9 THEN 'NA' ELSE '' END AS witness FROM statements")
def global_witness(spark, sf_dir):
    df = add_global_witness(view(spark, sf_dir, "statements"), [STMT.correspondent, STMT.currency, STMT.account], list(STMT.amounts), "witness")
    return df.select("row_id", "witness")


# ---- parsing --------------------------------------------------------------------------------------------------

_num = "replace(trim({}), ',', '.')"
NUMBER_SQL = "CASE WHEN regexp_full_match({0}, '(?i)[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') OR regexp_full_match({0}, '(?i)[+-]?inf(inity)?') THEN TRY_CAST({0} AS DOUBLE) END".replace("{0}", _num)


def number_sql(column: str) -> str:
    return NUMBER_SQL.replace("{}", column)


@query(f"WITH {cte('tx')} SELECT TauxDeChange, {number_sql('TauxDeChange')} AS number, count(*) AS n FROM tx GROUP BY 1, 2")
def number_parsing(spark, sf_dir):
    df = view(spark, sf_dir, "tx").select("TauxDeChange")
    return counted(df.withColumn("number", parse.to_number(df, "TauxDeChange")), "TauxDeChange", "number")


_days = {"2024-01-02": "2024-01-02", "25/12/2024": "2024-12-25", "03/04/2024": "2024-03-04", "20240102": "2024-01-02", "2024-01-02 10:11:12": "2024-01-02", "2024": "2024-01-01"}


@query(f"SELECT raw, (SELECT v FROM {table_of(_days)} WHERE k = raw) AS day, count(*) AS n FROM (SELECT {dirty('o_orderkey', TEXT_DATES)} AS raw FROM orders) GROUP BY 1, 2")
def date_parsing(spark, sf_dir):
    df = spark.sql(f"SELECT {dirty('o_orderkey', TEXT_DATES)} AS raw FROM {{orders}}", orders=rows(spark, sf_dir, "orders", "o_orderkey"))
    return counted(df.withColumn("day", parse.to_day(df, "raw").cast("string")), "raw", "day")


# ---- validation -----------------------------------------------------------------------------------------------

_amount, _rate = "MontantTransaction", number_sql("TauxDeChange")


@query(f"WITH {cte('tx')} SELECT row_id, 'AMOUNT_NON_NEGATIVE' AS Rule FROM tx WHERE {_amount} IS NULL OR {_amount} < 0 UNION ALL SELECT row_id, 'RATE_NON_NEGATIVE' FROM tx WHERE {_rate} IS NULL OR {_rate} < 0")
def amount_rate_rules(spark, sf_dir):
    df = view(spark, sf_dir, "tx")
    return anomalies(df, transaction_checks(df)[:2], ["row_id"]).select("row_id", "Rule")


def _date_rule(spark, sf_dir, inclusive: bool) -> DataFrame:
    df = view(spark, sf_dir, "tx")
    return anomalies(df, transaction_checks(df, TransactionColumns(inclusive=inclusive))[2:3], ["row_id"]).select("row_id", "Rule", "Severity")


_date_sql = "WITH " + cte("tx") + " SELECT row_id, 'DATE_VALIDITY' AS Rule, 'ERROR' AS Severity FROM tx WHERE DateTransaction IS NULL OR dtCr IS NULL OR CAST(DateTransaction AS DATE) {} CAST(dtCr AS DATE)"


@query(_date_sql.format(">="))
def date_rule_strict(spark, sf_dir):
    return _date_rule(spark, sf_dir, False)


@query(_date_sql.format(">"))
def date_rule_inclusive(spark, sf_dir):
    return _date_rule(spark, sf_dir, True)


_template = ["TypeSwfit", "ModeReglement", "Devise", "NomDonneurOrdre", "NifNni", "Produit", "NatureEconomique"]
_gaps = [f"CASE WHEN coalesce(upper(trim({c})), '') <> 'NA' THEN '{c}!=NA' END" for c in _template]
_gaps += ["CASE WHEN coalesce(upper(trim(Pays)), '') <> 'NOAS' THEN 'Pays!=NoAs' END", f"CASE WHEN {_amount} IS NULL OR abs({_amount}) > 1e-9 THEN 'MontantTransaction!=0' END", f"CASE WHEN {_rate} IS NULL OR abs({_rate}) > 1e-9 THEN 'TauxDeChange!=0' END"]


@query(f"WITH {cte('tx')}, g AS (SELECT row_id, concat_ws(', ', {', '.join(_gaps)}) AS gaps FROM tx WHERE upper(trim(ReferenceTransaction)) = 'NA') SELECT row_id, concat('Message sans activité (ReferenceTransaction=NA) non conforme au gabarit : ', gaps) AS Detail FROM g WHERE gaps <> ''")
def no_activity_template(spark, sf_dir):
    df = view(spark, sf_dir, "tx")
    return anomalies(df, transaction_checks(df)[3:], ["row_id"]).select("row_id", "Detail")


@query(f"WITH {cte('due')} SELECT row_id, 'AMOUNT_POSITIVE' AS Rule FROM due WHERE MontantEcheance IS NULL OR MontantEcheance <= 0 UNION ALL SELECT row_id, 'DATE_VALIDITY' FROM due WHERE DateEcheance IS NULL OR dtCr IS NULL OR CAST(DateEcheance AS DATE) <= CAST(dtCr AS DATE)")
def due_date_rules(spark, sf_dir):
    df = view(spark, sf_dir, "due")
    return anomalies(df, due_checks(df), ["row_id"]).select("row_id", "Rule")


_sum = "round_even(SoldeFinJournee - (SoldeDebutJournee + TotalMvtsCrediteurs - TotalMvtsDebiteursJournee), 2)"
_nulls = "(SoldeDebutJournee IS NULL OR TotalMvtsDebiteursJournee IS NULL OR TotalMvtsCrediteurs IS NULL OR SoldeFinJournee IS NULL)"


@query(f"WITH {cte('statements')} SELECT row_id, CASE WHEN NOT {_nulls} THEN {_sum} END AS Delta FROM statements WHERE {_nulls} OR abs({_sum}) > 0.01")
def arithmetic_rule(spark, sf_dir):
    df = view(spark, sf_dir, "statements")
    return anomalies(df, statement_checks(df)[:1], ["row_id"], with_delta=True).select("row_id", "Delta")


_all_na = "coalesce(NomCorrespondant = 'NA' AND Devise = 'NA' AND NumCompte = 'NA', FALSE)"
_some_na = "(coalesce(NomCorrespondant = 'NA', FALSE) OR coalesce(Devise = 'NA', FALSE) OR coalesce(NumCompte = 'NA', FALSE))"
_moved = "(" + " OR ".join(f"{c} IS NULL OR abs({c}) > 1e-9" for c in STMT.amounts) + ")"


@query(f"WITH {cte('statements')} SELECT row_id FROM statements WHERE ({_some_na} AND NOT {_all_na}) OR ({_all_na} AND {_moved})")
def no_activity_statement(spark, sf_dir):
    df = view(spark, sf_dir, "statements")
    return anomalies(df, statement_checks(df)[1:2], ["row_id"]).select("row_id")


@query(f"WITH {cte('statements')} SELECT row_id FROM statements WHERE DateFinJournee IS NULL OR dtCr IS NULL OR CAST(DateFinJournee AS DATE) > CAST(dtCr AS DATE)")
def date_validity_statement(spark, sf_dir):
    df = view(spark, sf_dir, "statements")
    return anomalies(df, statement_checks(df)[2:], ["row_id"]).select("row_id")


CHAIN = f"""WITH {cte('statements')}, k AS (SELECT *, count(*) OVER i AS same, row_number() OVER (i ORDER BY row_id) AS nth FROM statements WHERE NOT {_all_na} AND DateFinJournee IS NOT NULL WINDOW i AS (PARTITION BY RefBanque, NomCorrespondant, NumCompte, Devise, DateFinJournee)),
p AS (SELECT *, lag(SoldeFinJournee) OVER a AS pc, lag(DateFinJournee) OVER a AS pt FROM k WHERE nth = 1 WINDOW a AS (PARTITION BY RefBanque, NomCorrespondant, NumCompte, Devise ORDER BY DateFinJournee)),
q AS (SELECT *, SoldeDebutJournee IS NOT NULL AND pc IS NOT NULL AND pt IS NOT NULL AS pair, round_even(SoldeDebutJournee - pc, 2) AS delta, floor(epoch(DateFinJournee - pt) / 86400) AS days FROM p)
"""


def _chain(spark, sf_dir) -> DataFrame:
    return temporal_continuity(view(spark, sf_dir, "statements"), STMT, ["row_id"])


@query(CHAIN + "SELECT NumCompte, RefBanque, concat(CAST(same AS STRING), ' lignes pour la même date ', strftime(DateFinJournee, '%Y-%m-%d %H:%M:%S'), ' (compte ambigu)') AS Detail, Severity FROM (SELECT *, 'ERROR' AS Severity FROM k WHERE same > 1 AND nth = 1)")
def temporal_duplicates(spark, sf_dir):
    return _chain(spark, sf_dir).where(F.col("Detail").contains("lignes pour")).select("NumCompte", "RefBanque", "Detail", "Severity")


@query(CHAIN + "SELECT NumCompte, RefBanque, strftime(DateFinJournee, '%Y-%m-%d') AS day, delta AS Delta, 'ERROR' AS Severity FROM q WHERE pair AND abs(delta) > 0.01")
def temporal_breaks(spark, sf_dir):
    hits = _chain(spark, sf_dir).where(F.col("Delta").isNotNull() & (F.col("Severity") == "ERROR"))
    return hits.select("NumCompte", "RefBanque", F.date_format("DateFinJournee", "yyyy-MM-dd").alias("day"), "Delta", "Severity")


@query(CHAIN + "SELECT NumCompte, RefBanque, concat('Écart de ', CAST(CAST(days AS BIGINT) AS STRING), ' jours depuis le relevé précédent (', strftime(pt, '%Y-%m-%d'), ')') AS Detail, 0.0::DOUBLE AS Delta FROM q WHERE pair AND abs(delta) <= 0.01 AND days > 1")
def temporal_gaps(spark, sf_dir):
    return _chain(spark, sf_dir).where("Severity = 'WARNING'").select("NumCompte", "RefBanque", "Detail", "Delta")


_stmt_rules = f"""SELECT 'ARITHMETIC' AS Rule, 'ERROR' AS Severity, RefBanque, NumCompte FROM statements WHERE {_nulls} OR abs({_sum}) > 0.01
UNION ALL SELECT 'NO_ACTIVITY_CONFORMITY', 'ERROR', RefBanque, NumCompte FROM statements WHERE ({_some_na} AND NOT {_all_na}) OR ({_all_na} AND {_moved})
UNION ALL SELECT 'DATE_VALIDITY', 'ERROR', RefBanque, NumCompte FROM statements WHERE DateFinJournee IS NULL OR dtCr IS NULL OR CAST(DateFinJournee AS DATE) > CAST(dtCr AS DATE)
UNION ALL SELECT 'TEMPORAL_CONTINUITY', 'ERROR', RefBanque, NumCompte FROM k WHERE same > 1 AND nth = 1
UNION ALL SELECT 'TEMPORAL_CONTINUITY', CASE WHEN abs(delta) > 0.01 THEN 'ERROR' ELSE 'WARNING' END, RefBanque, NumCompte FROM q WHERE pair AND (abs(delta) > 0.01 OR days > 1)"""


@query(CHAIN + f"SELECT Rule, Severity, RefBanque, count(*) AS n FROM ({_stmt_rules}) GROUP BY 1, 2, 3")
def anomalies_union_all(spark, sf_dir):
    return counted(validate_statements(view(spark, sf_dir, "statements"), STMT, ["row_id"])[1], "Rule", "Severity", "RefBanque")


@query(CHAIN + f"SELECT Rule, count(*) AS n, count(*) > 0.2 * (SELECT count(*) FROM statements) AS dominant FROM ({_stmt_rules}) GROUP BY 1")
def rule_dominance(spark, sf_dir):
    df = view(spark, sf_dir, "statements")
    return quality.dominance(df.count(), validate_statements(df, STMT, ["row_id"])[1])


_stmt_bad = f"({_nulls} OR abs({_sum}) > 0.01 OR ({_some_na} AND NOT {_all_na}) OR ({_all_na} AND {_moved}) OR DateFinJournee IS NULL OR dtCr IS NULL OR CAST(DateFinJournee AS DATE) > CAST(dtCr AS DATE))"


@query(CHAIN + f"SELECT * FROM (SELECT count(*) AS n_rows, round_even(100.0 * sum(CASE WHEN {_stmt_bad} THEN 0 ELSE 1 END) / greatest(count(*), 1), 2) AS taux_conformite_pct FROM statements), (SELECT count(*) FILTER (Severity = 'ERROR') AS n_anomalies_error, count(*) FILTER (Severity = 'WARNING') AS n_anomalies_warning FROM ({_stmt_rules}))")
def anomaly_counts(spark, sf_dir):
    marked, found_ = validate_statements(view(spark, sf_dir, "statements"), STMT, ["row_id"])
    return quality.anomaly_counts(marked, found_, "_NC_row_conforme")


_tx_bad = f"({_amount} IS NULL OR {_amount} < 0 OR {_rate} IS NULL OR {_rate} < 0 OR DateTransaction IS NULL OR dtCr IS NULL OR CAST(DateTransaction AS DATE) >= CAST(dtCr AS DATE) OR (coalesce(upper(trim(ReferenceTransaction)), '') = 'NA' AND concat_ws(', ', {', '.join(_gaps)}) <> ''))"


@query(f"WITH {cte('tx')} SELECT row_id, NOT {_tx_bad} AS _TX_row_conforme FROM tx")
def row_conformity(spark, sf_dir):
    df = view(spark, sf_dir, "tx")
    return annotate(df, transaction_checks(df), "_TX_row_conforme").select("row_id", "_TX_row_conforme")


# ---- quality --------------------------------------------------------------------------------------------------


@query(currency_cte() + "SELECT DISTINCT Devise, Devise_Norm FROM rul WHERE Devise_Norm IS DISTINCT FROM 'OUTLIER'")
def mapping_pairs(spark, sf_dir):
    return quality.mapping_pairs(ruled(spark, sf_dir), "Devise", "Devise_Norm")


@query(currency_cte() + "SELECT DISTINCT Devise, Devise_Norm FROM rul WHERE Devise IS NOT NULL")
def classification_table(spark, sf_dir):
    return quality.classification(ruled(spark, sf_dir), "Devise", "Devise_Norm")


_totals = "count(*) FILTER (Devise_Norm = 'OUTLIER') AS Nombre_total_OUTLIERS, count(*) FILTER (Devise_Norm IS DISTINCT FROM 'OUTLIER') AS Nombre_total_CLEAN_VALUES, count(*) AS Nombre_total_LIGNES"


@query(currency_cte(f", t AS (SELECT RefBanque, {_totals} FROM rul GROUP BY 1), o AS (SELECT RefBanque, Devise, count(*) AS Nombre_OUTLIERS FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise IS NOT NULL GROUP BY 1, 2)") + "SELECT RefBanque, Devise, Nombre_OUTLIERS, round_even(100.0 * Nombre_OUTLIERS / greatest(Nombre_total_LIGNES, 1), 2) AS Ratio_OUTLIERS, Nombre_total_OUTLIERS, Nombre_total_CLEAN_VALUES, Nombre_total_LIGNES FROM o JOIN t USING (RefBanque)")
def outlier_stats(spark, sf_dir):
    return quality.outlier_stats(ruled(spark, sf_dir), "Devise", "Devise_Norm")


@query(currency_cte(f", t AS (SELECT {_totals} FROM rul), o AS (SELECT Devise, count(*) AS Nombre_OUTLIERS FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise IS NOT NULL GROUP BY 1)") + "SELECT Devise, Nombre_OUTLIERS, round_even(100.0 * Nombre_OUTLIERS / greatest(Nombre_total_LIGNES, 1), 2) AS Ratio_OUTLIERS, Nombre_total_OUTLIERS, Nombre_total_CLEAN_VALUES, Nombre_total_LIGNES FROM o, t")
def outlier_stats_global(spark, sf_dir):
    return quality.outlier_stats(ruled(spark, sf_dir).drop("RefBanque"), "Devise", "Devise_Norm")


_stats = "count(*) AS n_rows, count(DISTINCT Devise) AS n_distinct_total, count(DISTINCT CASE WHEN Devise_Norm IS DISTINCT FROM 'OUTLIER' THEN Devise END) AS n_distinct_normalized, count(*) FILTER (Devise_Norm = 'OUTLIER') AS n_outlier_rows"


@query(currency_cte(f", s AS (SELECT {_stats} FROM rul)") + "SELECT *, round_even(100.0 * n_distinct_normalized / greatest(n_distinct_total, 1), 2) AS taux_normalisation_pct, round_even(100.0 * n_outlier_rows / greatest(n_rows, 1), 2) AS taux_outliers_pct FROM s")
def field_stats(spark, sf_dir):
    return quality.field_stats(ruled(spark, sf_dir), "Devise", "Devise_Norm")


@query(currency_cte() + "SELECT Devise_method AS method, count(*) AS n_rows, count(DISTINCT Devise) AS n_distinct, Devise_method IN ('NOISE', 'MAP') AS known_noise FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise_method IS NOT NULL GROUP BY 1")
def outliers_by_method(spark, sf_dir):
    return quality.outliers_by_method(ruled(spark, sf_dir), "Devise", "Devise_Norm")


@query(currency_cte() + "SELECT coalesce(sum(n) FILTER (m2 IN ('NOISE', 'MAP')), 0)::BIGINT AS known, coalesce(sum(n) FILTER (m2 NOT IN ('NOISE', 'MAP')), 0)::BIGINT AS new FROM (SELECT Devise_method AS m2, count(DISTINCT Devise) AS n FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise_method IS NOT NULL GROUP BY 1)")
def known_noise_split(spark, sf_dir):
    return quality.known_noise_split(ruled(spark, sf_dir), "Devise", "Devise_Norm")


@query(currency_cte(f", f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Devise ORDER BY row_id) AS k FROM rul) WHERE k = 1), z AS (SELECT Devise_Norm, NOT coalesce(Devise_method IN ({listed(words.KNOWN_METHODS)}), FALSE) AS new FROM f1)") + "SELECT count(*) FILTER (new) AS n_new_distinct, count(*) FILTER (new AND Devise_Norm IS DISTINCT FROM 'OUTLIER') AS n_new_normalized, count(*) FILTER (new AND Devise_Norm = 'OUTLIER') AS n_new_outliers FROM z")
def new_values_first_seen(spark, sf_dir):
    return quality.new_values(ruled(spark, sf_dir), "Devise", "Devise_Norm", ["row_id"])


_cumulative = "n_distinct_normalized - n_already_clean AS n_cleaned, n_distinct_total - n_distinct_normalized AS n_outliers, round_even(100.0 * n_already_clean / greatest(n_distinct_total, 1), 2) AS already_clean_pct, round_even(100.0 * (n_distinct_normalized - n_already_clean) / greatest(n_distinct_total, 1), 2) AS cleaned_pct, round_even(100.0 * (n_distinct_total - n_distinct_normalized) / greatest(n_distinct_total, 1), 2) AS outliers_pct"


@query(currency_cte(", d AS (SELECT DISTINCT Devise, Devise_Norm FROM rul WHERE Devise IS NOT NULL), s AS (SELECT count(*) AS n_distinct_total, count(*) FILTER (Devise_Norm IS DISTINCT FROM 'OUTLIER') AS n_distinct_normalized, count(*) FILTER (Devise_Norm IS DISTINCT FROM 'OUTLIER' AND Devise = Devise_Norm) AS n_already_clean FROM d)") + f"SELECT *, {_cumulative} FROM s")
def already_clean_split(spark, sf_dir):
    return quality.cumulative_stats([(quality.classification(ruled(spark, sf_dir), "Devise", "Devise_Norm"), "Devise", "Devise_Norm")])


def measured(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return validate_transactions(ruled(spark, sf_dir))


@query(currency_cte(f", b AS (SELECT *, Devise_Norm IS NOT DISTINCT FROM 'OUTLIER' OR {_tx_bad} AS bad FROM rul)") + "SELECT count(*) AS n_rows, count(*) FILTER (bad) AS n_outlier_rows, round_even(100.0 * count(*) FILTER (NOT bad) / greatest(count(*), 1), 2) AS taux_conformite_pct, round_even(100.0 * count(*) FILTER (bad) / greatest(count(*), 1), 2) AS taux_outliers_pct FROM b")
def quality_kpis(spark, sf_dir):
    return quality.run_indicators(measured(spark, sf_dir)[0], ["Devise_Norm"])


_tx_errors = f"""SELECT 'AMOUNT_NON_NEGATIVE' AS Rule, RefBanque, ReferenceTransaction FROM rul WHERE {_amount} IS NULL OR {_amount} < 0 UNION ALL SELECT 'RATE_NON_NEGATIVE', RefBanque, ReferenceTransaction FROM rul WHERE {_rate} IS NULL OR {_rate} < 0
UNION ALL SELECT 'DATE_VALIDITY', RefBanque, ReferenceTransaction FROM rul WHERE DateTransaction IS NULL OR dtCr IS NULL OR CAST(DateTransaction AS DATE) >= CAST(dtCr AS DATE)
UNION ALL SELECT 'NO_ACTIVITY_CONFORMITY', RefBanque, ReferenceTransaction FROM rul WHERE coalesce(upper(trim(ReferenceTransaction)), '') = 'NA' AND concat_ws(', ', {', '.join(_gaps)}) <> ''"""


@query(currency_cte() + f"SELECT 'Devise' AS champ, count(*) FILTER (Devise_Norm = 'OUTLIER') AS n FROM rul UNION ALL SELECT Rule, count(*) FROM ({_tx_errors}) GROUP BY 1")
def outliers_by_field(spark, sf_dir):
    rows_, found_ = measured(spark, sf_dir)
    return quality.outliers_by_field(rows_, {"Devise": "Devise_Norm"}, found_)


_by_bank = f"SELECT RefBanque, count(*) AS n FROM (SELECT RefBanque FROM rul WHERE Devise_Norm = 'OUTLIER' OR {_tx_bad} UNION ALL SELECT RefBanque FROM ({_tx_errors})) WHERE RefBanque IS NOT NULL GROUP BY 1"


@query(currency_cte() + _by_bank)
def outliers_by_bank(spark, sf_dir):
    rows_, found_ = measured(spark, sf_dir)
    return quality.outliers_by_bank(rows_, ["Devise_Norm"], found_)


LABELS = {"Devise": "devise", "AMOUNT_NON_NEGATIVE": "montant", "RATE_NON_NEGATIVE": "taux", "DATE_VALIDITY": "date", "NO_ACTIVITY_CONFORMITY": "date"}
_shown = "CASE Rule " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " END"
_detail = f"(SELECT RefBanque AS bank, 'devise' AS champ, Devise AS valeur, count(*) AS n FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise IS NOT NULL AND RefBanque IS NOT NULL GROUP BY ALL UNION ALL SELECT bank, {_shown}, ReferenceTransaction, n FROM (SELECT RefBanque AS bank, Rule, ReferenceTransaction, count(*) AS n FROM ({_tx_errors}) WHERE RefBanque IS NOT NULL AND ReferenceTransaction IS NOT NULL GROUP BY ALL))"


def _details(spark, sf_dir) -> DataFrame:
    rows_, found_ = measured(spark, sf_dir)
    return quality.bank_detail({"Devise": (quality.outlier_stats(rows_, "Devise", "Devise_Norm"), "Devise")}, [(found_, "ReferenceTransaction")], LABELS)


@query(currency_cte() + f"SELECT bank, champ, valeur, n FROM {_detail}")
def bank_detail(spark, sf_dir):
    return _details(spark, sf_dir)


@query(currency_cte(f", p AS (SELECT bank, CAST(sum(n) AS BIGINT) AS n FROM {_detail} GROUP BY 1)") + "SELECT bank, n, round_even(100.0 * n / greatest((SELECT sum(n) FROM p), 1), 1) AS pct FROM p ORDER BY n DESC, bank LIMIT 5")
def top_banks(spark, sf_dir):
    return quality.top_banks(_details(spark, sf_dir), 5)


@query(currency_cte(f", o AS (SELECT 'Devise' AS champ, count(*) FILTER (Devise_Norm = 'OUTLIER') AS n FROM rul UNION ALL SELECT Rule, count(*) FROM ({_tx_errors}) GROUP BY 1), l(place, label) AS (VALUES (0, 'devise'), (1, 'pays'), (2, 'montant'), (3, 'taux'), (4, 'date'))") + f"SELECT CAST(place AS INT) AS place, label, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, round_even(100.0 * coalesce(sum(n), 0) / greatest((SELECT sum(n) FROM o), 1), 1) AS pct FROM l LEFT JOIN (SELECT n, CASE champ {' '.join(f'''WHEN '{k}' THEN '{v}' ''' for k, v in LABELS.items())} END AS label FROM o) USING (label) GROUP BY 1, 2")
def field_synthesis_zero_filled(spark, sf_dir):
    rows_, found_ = measured(spark, sf_dir)
    return quality.field_synthesis(quality.outliers_by_field(rows_, {"Devise": "Devise_Norm"}, found_), ["devise", "pays", "montant", "taux", "date"], LABELS)


# ---- memory, corrections, outputs -----------------------------------------------------------------------------


@query(f"SELECT k AS Devise, v AS Devise_Norm FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY i DESC) AS t FROM (SELECT k, v, 0 AS i FROM {table_of(words.CURRENCY_ALIASES)} UNION ALL SELECT k, v, 1 FROM {table_of(SAME)} UNION ALL SELECT k, v, 2 FROM {table_of(MEMORY | {'EURO': 'XOF'})})) WHERE t = 1")
def cumulative_mapping(spark, sf_dir):
    return memory.cumulative_mapping([pairs(spark, words.CURRENCY_ALIASES), pairs(spark, SAME), pairs(spark, MEMORY | {"EURO": "XOF"})], "Devise", "Devise_Norm")


_sheet = "SELECT o_orderstatus AS Champ, concat('  ', o_orderpriority, ' ') AS Input, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(o_orderstatus, '   ', CAST(o_custkey % 3 AS STRING)) END AS Label_Attendu FROM {orders}"


@query("WITH s AS (" + _sheet.replace("{orders}", "orders") + r"), f AS (SELECT Champ, trim(Input) AS i, upper(regexp_replace(trim(Label_Attendu), '\s+', ' ', 'g')) AS v FROM s WHERE trim(Label_Attendu) <> ''), e AS (SELECT Champ, unnest(list_distinct([lower(i), i, upper(i)])) AS k, v FROM f) SELECT Champ, k, v, count(*) AS n FROM e WHERE k <> '' GROUP BY 1, 2, 3")
def corrections_explode(spark, sf_dir):
    sheet = spark.sql(_sheet, orders=rows(spark, sf_dir, "orders", "*"))
    return counted(memory.correction_rows(sheet, F.lower(text.ustrip(F.col("Input")))), "Champ", "k", "v")




@query("WITH h AS (SELECT '2024-01-01' AS date, 'F' AS champ, '1-URGENT' AS input, '0' AS label_attendu), n AS (SELECT '2024-02-02' AS date, o_orderstatus AS champ, o_orderpriority AS input, CAST(o_custkey % 7 AS STRING) AS label_attendu FROM orders) SELECT * FROM h UNION ALL SELECT min(date), champ, input, label_attendu FROM n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.champ = n.champ AND h.input = n.input AND h.label_attendu = n.label_attendu) GROUP BY 2, 3, 4")
def history_dedup(spark, sf_dir):
    old = spark.createDataFrame([("2024-01-01", "F", "1-URGENT", "0")], "date string, champ string, input string, label_attendu string")
    new = rows(spark, sf_dir, "orders", F.lit("2024-02-02").alias("date"), F.col("o_orderstatus").alias("champ"), F.col("o_orderpriority").alias("input"), (F.col("o_custkey") % 7).cast("string").alias("label_attendu"))
    return memory.append_history(old, new)


@query("SELECT k, arg_max(v, i) AS v FROM (SELECT CAST(c_nationkey AS STRING) AS k, min(c_mktsegment) AS v, 0 AS i FROM customer GROUP BY 1 UNION ALL SELECT CAST(s_nationkey AS STRING), 'SUPPLIER', 1 FROM supplier WHERE s_nationkey < 10) GROUP BY 1")
def memory_upsert(spark, sf_dir):
    old = rows(spark, sf_dir, "customer", "*").groupBy(F.col("c_nationkey").cast("string").alias("k")).agg(F.min("c_mktsegment").alias("v"))
    new = rows(spark, sf_dir, "supplier", "*").where("s_nationkey < 10").select(F.col("s_nationkey").cast("string").alias("k"), F.lit("SUPPLIER").alias("v")).distinct()
    return memory.upsert(old, new, ["k"])


@query(currency_cte() + "SELECT DISTINCT Devise, CASE WHEN Devise IN ('@@', 'NA') THEN 'cache' WHEN Devise IN ('XXX') THEN 'static' ELSE 'never_seen' END AS origin FROM rul WHERE Devise_Norm = 'OUTLIER' AND Devise IS NOT NULL")
def outlier_known_split(spark, sf_dir):
    out = ruled(spark, sf_dir).where("Devise_Norm = 'OUTLIER'")
    return memory.outlier_origin(out, pairs(spark, {"@@": "OUTLIER", "NA": "OUTLIER"}), pairs(spark, {"XXX": "OUTLIER", "NA": "OUTLIER"}), "Devise")


@query(f"WITH {cte('due')} SELECT row_id FROM due WHERE MontantEcheance IS NULL OR MontantEcheance <= 0 ORDER BY row_id LIMIT 100")
def anomaly_cap(spark, sf_dir):
    df = view(spark, sf_dir, "due")
    return sinks.cap_anomalies(anomalies(df, due_checks(df)[:1], ["row_id"]), ["row_id"], 100)[0].select("row_id")


@query(currency_cte() + "SELECT row_id, ReferenceTransaction, Devise, Devise_Norm, MontantTransaction FROM rul")
def extraction_frame(spark, sf_dir):
    return sinks.extraction_frame(ruled(spark, sf_dir), ["row_id", "ReferenceTransaction", "Devise", "MontantTransaction"], {"Devise": "Devise_Norm"})
