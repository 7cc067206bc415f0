import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqloom import dictionaries
from dqloom.operators import fields, memory, resolver
from dqloom.operators.cascade import pairs
from dqloom.operators.no_activity import apply_country_rule, apply_na_rule
from dqloom.operators.similarity_join import best_names


def resolved(spark, kind, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return {r.v: (r.value, r.method) for r in fields.RESOLVERS[kind](df, "v", **options).collect()}


CUR = {"codes": ["USD", "EUR", "MRU", "ALL"], "numbers": {"840": "USD"}}


def test_currency_branches(spark):
    got = resolved(spark, "currency", ["usd", "840", "840.0", "euros", "USD (dollar)", "E.U.R", "USDX", "XXX", "@@", "", "ALLEMAGNE", "dollar US", "US DOLLAR", "memo ", "usd  "], memory={"memo": "EUR", "usd  ": "MRU"}, **CUR)
    assert got == {
        "usd": ("USD", "MAP"), "840": ("USD", "NUM"), "840.0": ("USD", "NUM"), "euros": ("EUR", "ALIAS"), "USD (dollar)": ("USD", "STRIP"), "E.U.R": ("EUR", "STRIP"), "USDX": ("USD", "STRIP"), "XXX": ("OUTLIER", "NOISE"),
        "@@": ("OUTLIER", "OUTLIER"), "": (None, None), "ALLEMAGNE": ("ALL", "STRIP"), "dollar US": ("OUTLIER", "OUTLIER"), "US DOLLAR": ("USD", "ALIAS"), "memo ": ("EUR", "WARM"), "usd  ": ("MRU", "WARM"),
    }


def test_message_and_payment_branches(spark):
    assert resolved(spark, "message_type", ["mt 103", "103", "12345", "1,5", "PACS.004", "zz", " "]) == {"mt 103": ("MT 103", "MAP"), "103": ("MT 103", "PREFIX"), "12345": ("OUTLIER", "NOISE"), "1,5": ("OUTLIER", "NOISE"), "PACS.004": ("OUTLIER", "OUTLIER"), "zz": ("OUTLIER", "OUTLIER"), " ": (None, None)}
    assert resolved(spark, "message_type", ["PACS.004"], flow="IN") == {"PACS.004": ("pacs.004", "MAP")}
    assert resolved(spark, "payment_mode", ["tr", "c d", "SWIFT", "x"]) == {"tr": ("TL", "ALIAS"), "c d": ("CD", "MAP"), "SWIFT": ("OUTLIER", "NOISE"), "x": ("OUTLIER", "OUTLIER")}


def test_country_branches_in_the_order_of_the_code(spark):
    names, codes = {"france": "FR", "maroc": "MA", "mauritanie": "MR", "cote d'ivoire": "CI"}, ["FR", "MA", "CI", "MR"]
    got = resolved(spark, "country", ["France", "fr", "12", "NOGAS", "Mauritanies", "rue de paris", "republic of morris", "qqq", "NAMIBIE", "  "], names=names, codes=codes, address_words={"paris": "FR", "rue de paris": "XX"})
    assert got == {"France": ("FR", "MAP"), "fr": ("FR", "MAP"), "12": ("OUTLIER", "OUTLIER"), "NOGAS": ("OUTLIER", "OUTLIER"), "Mauritanies": ("MR", "FUZZY"), "rue de paris": ("XX", "ADDR"), "republic of morris": ("OUTLIER", "OUTLIER"), "qqq": ("check", "check"), "NAMIBIE": ("check", "check"), "  ": (None, None)}


def test_country_names_come_from_the_locale_data(spark):
    names, codes = dictionaries.country_names(spark)
    assert names["france"] == "FR" and names["allemagne"] == "DE" and names["germany"] == "DE" and names["mrt"] == "MR" and "MR" in codes and len(codes) > 240
    assert resolved(spark, "country", ["Royaume-Uni", "Spain", "usa"], fuzzy=None) == {"Royaume-Uni": ("GB", "MAP"), "Spain": ("ES", "MAP"), "usa": ("US", "MAP")}
    valid, numbers = dictionaries.currencies(spark)
    assert "EUR" in valid and numbers["840"] == "USD"


def test_nature_product_correspondent(spark):
    got = resolved(spark, "nature", ["Fret", "divers", "NA", "", "Ahmed Ould", "12345", "Voyages", "???", "something else"], names=["AHMED"])
    assert got == {"Fret": ("TRANSPORT MARITIME", "MAP"), "divers": ("OUTLIER", "NOISE"), "NA": ("OUTLIER", "OUTLIER"), "": (None, None), "Ahmed Ould": ("OUTLIER", "NOISE"), "12345": ("OUTLIER", "NOISE"), "Voyages": ("VOYAGES", "MAP"), "???": ("OUTLIER", "NOISE"), "something else": (None, None)}
    assert resolved(spark, "product", ["riz", "diesel", "NA", "TEST", "x"]) == {"riz": ("RIZ", "MAP_CIBLE"), "diesel": ("GASOIL", "MAP"), "NA": ("OUTLIER", "OUTLIER"), "TEST": ("OUTLIER", "NOISE"), "x": (None, None)}
    mapping = {"Natixis Paris": "NATIXIS"}
    assert resolved(spark, "correspondent", ["natixis", "Natixis  Paris", "natixis paris", "na"], mapping=mapping) == {"natixis": ("NATIXIS", "MAP_CIBLE"), "Natixis  Paris": ("NATIXIS", "MAP"), "natixis paris": (None, None), "na": ("OUTLIER", "OUTLIER")}


BASE = [(0, "17", "Société Alpha SARL"), (1, "00000018", "BETA INDUSTRIES"), (2, "00000017", "SECOND OF THAT ID"), (3, "x", "GAMMA TRADING COMPANY")]


def entities(spark):
    base = spark.createDataFrame([(i, n, r, "SARL") for i, n, r in BASE], "place int, NIF string, RAISON_SOCIALE string, FORME_JURIDIQUE string")
    public = spark.createDataFrame([(0, "SOMELEC", "Societe Mauritanienne d'Electricite"), (1, "SAM", "Societe des Aeroports")], ["place", "Short Name", "Raison social - Public Ent"])
    return base, public


def test_local_entity_branches(spark):
    base, public = entities(spark)
    rows = [("Anything", "00-00-00-17"), ("societe alpha s.a.r.l", None), ("SOMELEC Nouakchott", None), ("Mohamed Ould Ahmed", None), ("ETS Mohamed Salem", None), ("ETS du Nord", None), ("12345", None), ("NA", None), (" ", None), ("BETA INDUSTRIE", "11111111"), ("zzzz qqqq wwww", None), ("Sam Trading Monaco", None), ("KNOWN", None), ("Final Name", None), ("ALI ET FILS", None), ("GAMMA TRADE CO", None), ("SOC MAURITANIENNE ELECTRICITE", None)]
    df = spark.createDataFrame(rows, "n string, t string")
    out, settled = fields.local_entity(df, "n", "t", base, public, memory={"KNOWN": "REMEMBERED"}, mapping={"x": "Final Name"}, names=["MOHAMED"])
    got = {r.n: (r.value, r.method) for r in out.collect()}
    assert got["Anything"] == ("Société Alpha SARL", "NIF_EXACT") and got["societe alpha s.a.r.l"] == ("Société Alpha SARL", "DGI_EXACT_NORM")
    assert got["SOMELEC Nouakchott"] == ("SOMELEC", "PUBLIC_ENT") and got["Mohamed Ould Ahmed"] == ("MOHAMED OULD AHMED", "PARTICULIER")
    assert got["ETS Mohamed Salem"] == ("ETS MOHAMED SALEM", "ETS_PERSONNEL") and got["ETS du Nord"] == ("OUTLIER", "ETS_OUTLIER") and got["12345"] == ("OUTLIER", "OUTLIER") and got["NA"] == ("OUTLIER", "OUTLIER") and got[" "] == (None, None)
    assert got["BETA INDUSTRIE"] == ("BETA INDUSTRIES", "DGI_FUZZY_STRONG") and got["zzzz qqqq wwww"] == ("OUTLIER", "DGI_NO_MATCH")
    assert got["KNOWN"] == ("REMEMBERED", "WARM") and got["Final Name"] == ("Final Name", "MAP_CIBLE") and got["ALI ET FILS"][1] != "PARTICULIER" and got["Sam Trading Monaco"][1] != "PUBLIC_ENT"
    assert got["GAMMA TRADE CO"] == ("OUTLIER", "OUTLIER")  # near a name, and nobody to ask
    cache = memory.cacheable_matches(settled.select(F.col("k").alias("clean"), F.col("v").alias("value"), "method"))
    assert {r.k for r in cache.collect()} >= {"ZZZZ QQQQ WWWW", "BETA INDUSTRIE"} and "GAMMA TRADE CO" not in {r.k for r in cache.collect()}
    again, _ = fields.local_entity(df, "n", "t", base, public, memory={"KNOWN": "REMEMBERED"}, mapping={"x": "Final Name"}, cache=cache, names=["MOHAMED"])
    assert {r.n: (r.value, r.method) for r in again.collect()} == got


def test_arbitration_and_public_redirect(spark):
    base, public = entities(spark)
    base = base.unionByName(spark.createDataFrame([(9, "1", "SOCIETE MAURITANIENNE D ELECTRICITE", "SA")], base.schema))
    df = spark.createDataFrame([("GAMMA TRADE CO", None), ("SOCIETE MAURITANIENNE DELECTRICITE", None), ("GAMMA COMPAGNY", None), ("GAMMA TRAD", None)], "n string, t string")

    def client(batch):
        if any("COMPAGNY" in v for v in batch):
            raise TimeoutError
        return "\n".join(f"{i}. {'OUTLIER' if v.startswith('GAMMA TRAD |') else '1'}" for i, v in enumerate(batch, 1))

    out, _ = fields.local_entity(df, "n", "t", base, public, arbitrator=lambda near: resolver.arbitrate(near, client, resolver.Options(batch=1)))
    got = {r.n: (r.value, r.method) for r in out.collect()}
    assert got["GAMMA TRADE CO"] == ("GAMMA TRADING COMPANY", "DGI_CLAUDE_ARBITRAGE") and got["GAMMA TRAD"] == ("OUTLIER", "DGI_CLAUDE_ARBITRAGE") and got["GAMMA COMPAGNY"] == ("OUTLIER", "OUTLIER")
    assert got["SOCIETE MAURITANIENNE DELECTRICITE"] == ("SOMELEC", "PUBLIC_ENT")
    rows = fields.entity_field(df.withColumn("w", F.lit("R")), "n", "o", "t", base, "w", entities=public)
    assert rows.count() == 4 and {"n_clean", "n_method", "n_check", "o"} <= set(rows.columns)


def test_dictionary_files(tmp_path):
    import json

    path = tmp_path / "m.json"
    path.write_text(json.dumps({"classif": {"a": "B"}}))
    assert dictionaries.memory_from(str(path)) == {"a": "B"} and dictionaries.memory_from(str(tmp_path / "no.json")) == {}
    assert dictionaries.options_from("message_type", {"valid_fe": ["X"], "known_noise": []}, "IN") == {"codes": ["X"], "noise": []}


def test_best_names_over_blocks_is_the_same(spark, monkeypatch):
    names = spark.createDataFrame([(i, f"NAME {i * 37 % 101} {'ABC'[i % 3]}") for i in range(150)], "place bigint, name string")
    labels = spark.createDataFrame([("NAME 5 A",), ("NAME 77",), ("other",)], "label string")
    one = sorted(map(tuple, best_names(labels, names).collect()))
    monkeypatch.setattr("dqloom.operators.similarity_join.BLOCK_NAMES", 40)
    assert sorted(map(tuple, best_names(labels, names).collect())) == one and len(one) == 9


def na_spec(field, witness, value, method):
    """An independent statement of the no-activity rule."""
    f, w = (field or "").strip().upper(), (witness or "").strip().upper()
    if f == "NA":
        return ("NA", "NA") if w == "NA" else ("OUTLIER", "OUTLIER")
    if f in ("", "NAN", "NONE", "NULL"):
        return ("OUTLIER", "OUTLIER")
    return ("OUTLIER", method or "OUTLIER") if value == "OUTLIER" else (value, method)


TOKENS = st.sampled_from([None, "", " ", "NA", " na", "nan", "None", "NULL", "USD", "x"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TOKENS, TOKENS, st.sampled_from([None, "OUTLIER", "USD"]), st.sampled_from([None, "", "MAP", "NOISE"])), min_size=1, max_size=40))
def test_na_rule_is_its_specification(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f string, w string, v string, m string")
    got = apply_na_rule(df, "f", "w", "v", "m").orderBy("i").collect()
    assert [(r.v, r.m) for r in got] == [na_spec(*r) for r in rows]
    assert apply_na_rule(df, "f", "absent", "v", "m") is df


def test_country_rule(spark):
    rows = [("NA", "R1"), ("NA", ""), (None, "NA"), (None, "R1"), ("noas", "R1"), ("NaOs", None), ("France", "R1"), ("zz", "R1")]
    df = spark.createDataFrame([(i, f, w, "OUTLIER" if f == "zz" else "FR", "WARM") for i, (f, w) in enumerate(rows)], "i int, f string, w string, v string, m string")
    got = [(r.v, r.m) for r in apply_country_rule(df, "f", "w", "v", "m").orderBy("i").collect()]
    assert got == [("NA", "MAP"), ("NoAs", "NoAs"), ("NoAs", "NoAs"), ("OUTLIER", "OUTLIER"), ("OUTLIER", "OUTLIER"), ("NoAs", "NoAs"), ("FR", "WARM"), ("OUTLIER", "OUTLIER")]


def test_field_on_rows_with_duplicates_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, "usd", "R"), (2, None, "R"), (3, "usd", "NA"), (4, "NA", "NA"), (5, "@@", "R")], "i int, Devise string, ref string")
    out = {r.i: r for r in fields.field(df, "currency", "Devise", "Devise_Normalisée", "ref", **CUR).collect()}
    assert [(out[i]["Devise_Normalisée"], out[i].Devise_method, out[i].Devise_check) for i in range(1, 6)] == [("USD", "MAP", False), ("OUTLIER", "OUTLIER", True), ("USD", "MAP", False), ("NA", "NA", False), ("OUTLIER", "OUTLIER", True)]
    assert fields.field(df.limit(0), "currency", "Devise", "o", "ref", **CUR).count() == 0


def test_resolver_outcomes(spark):
    df = spark.createDataFrame([("fret aérien",), ("strange",), ("boom",), ("Fret",)], "v string")
    first = fields.nature(df, "v")

    def client(batch):
        if "boom" in batch:
            raise TimeoutError
        return "\n".join(f"{i}. {'Transport aerien' if 'fret' in v else 'not on the list'}" for i, v in enumerate(batch, 1))

    answers = resolver.ask(first.where("method is null").select(F.col("v").alias("value")), client, ["TRANSPORT AERIEN"], resolver.Options(batch=1)).persist()
    assert {r.value: (r.label, r.status) for r in answers.collect()} == {"fret aérien": ("TRANSPORT AERIEN", "verdict"), "strange": ("OUTLIER", "verdict"), "boom": (None, "technical_failure")}
    got = {r.v: (r.value, r.method) for r in resolver.settle(first, "v", answers).collect()}
    assert got == {"fret aérien": ("TRANSPORT AERIEN", "CLAUDE"), "strange": ("OUTLIER", "OUTLIER"), "boom": ("OUTLIER", "OUTLIER"), "Fret": ("TRANSPORT MARITIME", "MAP")}
    assert {r.k for r in resolver.remembered(answers).collect()} == {"fret aérien", "strange"}
    capped = resolver.ask(answers.select("value"), client, options=resolver.Options(most=1))
    assert sorted(r.status for r in capped.collect()).count("deferred") == 2
    assert {r.status for r in resolver.ask(answers.select("value"), resolver.offline).collect()} == {"technical_failure"}


def test_arbitration(spark):
    near = spark.createDataFrame([("A", 1, "ONE"), ("A", 2, "TWO"), ("B", 1, "X")], "label string, rank int, name string")
    got = {r.label: (r.value, r.method, r.status) for r in resolver.arbitrate(near, lambda b: "\n".join(f"{i}. {'2' if v.startswith('A') else 'OUTLIER'}" for i, v in enumerate(b, 1))).collect()}
    assert got == {"A": ("TWO", "DGI_CLAUDE_ARBITRAGE", "verdict"), "B": ("OUTLIER", "DGI_CLAUDE_ARBITRAGE", "verdict")}


def test_corrections_go_under_three_forms_and_win(spark):
    sheet = spark.createDataFrame([("Devise", " Bleu ", "pacs.008  x"), ("Devise", "", "y"), ("Devise", "z", None)], "Champ string, Input string, Label_Attendu string")
    rows = memory.correction_rows(sheet, F.lower(F.trim("Input")))
    assert {(r.k, r.v) for r in rows.collect()} == {("bleu", "PACS.008 X"), ("Bleu", "PACS.008 X"), ("BLEU", "PACS.008 X")}
    assert {r.v for r in memory.correction_rows(sheet, F.lower(F.trim("Input")), preserve_case=True).collect()} == {"pacs.008 x"}
    report = memory.correction_report(sheet, ["Pays"]).first()
    assert (report.n_rows, report.n_incomplete, report.known) == (3, 2, False)
    assert resolved(spark, "currency", ["Bleu"], memory=rows.select("k", "v"), **CUR) == {"Bleu": ("PACS.008 X", "WARM")}


def test_fingerprints_tell_bases_apart(spark):
    a = spark.createDataFrame([("ab",), ("cd",)], "RAISON_SOCIALE string")
    b = spark.createDataFrame([("ac",), ("bd",)], "RAISON_SOCIALE string")
    assert memory.base_fingerprint(a) == memory.base_fingerprint(a.orderBy(F.desc("RAISON_SOCIALE"))) != memory.base_fingerprint(b)


def test_dictionaries_with_equal_keys_dont_multiply_rows(spark):
    assert {(r.k, r.v) for r in pairs(spark, [("A", "1"), ("a", "2")], F.upper).collect()} == {("A", "1")}
    assert {(r.k, r.v) for r in pairs(spark, [("A", "1"), ("a", "2")], F.upper, last_wins=True).collect()} == {("A", "2")}


@pytest.mark.parametrize("kind", sorted(fields.RESOLVERS))
def test_empty_and_null_columns(spark, kind):
    df = spark.createDataFrame([], "v string")
    assert fields.field(df, kind, "v", "o", None).count() == 0
    out = fields.field(spark.createDataFrame([(None,), (None,)], "v string"), kind, "v", "o", "w").collect()
    assert len(out) == 2 and all(r.o is None for r in out)
