"""Resolution of each categorical field: its keys and its cascade.

Each function takes a table of distinct raw values and returns it with clean, value and method; null results
are left to the no-activity rules or to a resolver. field() turns that into columns on rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as words
from ..functions import text
from .cascade import OUTLIER, Rule, Table, attach, cut, distinct_values, first_per_key, memory_steps, pairs, resolve, target_index
from .no_activity import apply_country_rule, apply_na_rule
from .similarity_join import best_names, first_token_hit, longest_contained


def memory_table(df_or_dict, spark) -> DataFrame:
    """The validated values as k, v. A dictionary, a table k, v, or None for none."""
    if df_or_dict is None:
        return spark.createDataFrame([], "k string, v string")
    return pairs(spark, df_or_dict, last_wins=True) if isinstance(df_or_dict, (dict, list)) else df_or_dict


def _is_in(c: Column, values: list[str]) -> Column:
    return c.isin(list(dict.fromkeys(values)))


def currency(values: DataFrame, raw: str, memory=None, codes=None, numbers=None, aliases=None, noise=None) -> DataFrame:
    spark = values.sparkSession
    if codes is None or numbers is None:
        codes, numbers = words.currencies(spark)
    aliases, noise = aliases if aliases is not None else words.CURRENCY_ALIASES, noise if noise is not None else words.CURRENCY_NOISE
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    valid, named = pairs(spark, {c: c for c in codes}), pairs(spark, aliases)
    cut = text.before_parenthesis(clean)
    bare = text.alnum_only(clean)
    start = F.when(F.length(bare) > 3, F.substring(bare, 1, 3))
    steps = [
        *memory_steps(memory_table(memory, spark), [r, text.urstrip(r)]),
        Rule(None, clean == "", None),
        Rule("NOISE", _is_in(clean, noise)),
        Table("MAP", valid, clean),
        Table("NUM", pairs(spark, numbers), F.when(clean.rlike(r"^\d{3}$"), clean)),
        Table("ALIAS", named, clean),
        *[Table("STRIP", table, F.when(key != "", key)) for key in (cut, bare, start) for table in (valid, named)],
    ]
    return resolve(values.withColumn("clean", text.clean_currency(r)), steps)


def message_type(values: DataFrame, raw: str, memory=None, flow: str = "OUT", codes=None, noise=None) -> DataFrame:
    spark = values.sparkSession
    codes = codes if codes is not None else words.MESSAGE_TYPES_OUT if flow == "OUT" else words.MESSAGE_TYPES_IN
    noise = [n.upper().replace(" ", "") for n in (noise if noise is not None else words.MESSAGE_NOISE)]
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    lookup = pairs(spark, {c: c for c in codes}, text.compact_key)
    steps = [
        *memory_steps(memory_table(memory, spark), [r, text.urstrip(r), clean]),
        Rule(None, clean == "", None),
        Rule("NOISE", _is_in(clean, noise) | clean.rlike(r"[\d,.]{5,}|,")),
        Table("MAP", lookup, clean),
        Table("PREFIX", lookup, F.when(clean.rlike(r"^\d{3}$"), F.concat(F.lit("MT"), clean))),
    ]
    return resolve(values.withColumn("clean", text.compact_key(r)), steps)


def payment_mode(values: DataFrame, raw: str, memory=None, modes=None, aliases=None, noise=None) -> DataFrame:
    spark = values.sparkSession
    noise = [n.upper().replace(" ", "") for n in (noise if noise is not None else words.PAYMENT_NOISE)]
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    steps = [
        *memory_steps(memory_table(memory, spark), [r, text.ustrip(r), text.urstrip(r), clean]),
        Rule(None, clean == "", None),
        Rule("NOISE", _is_in(clean, noise)),
        Table("MAP", pairs(spark, {m: m for m in (modes or words.PAYMENT_MODES)}, text.compact_key), clean),
        Table("ALIAS", pairs(spark, aliases if aliases is not None else words.PAYMENT_ALIASES, text.compact_key), clean),
    ]
    return resolve(values.withColumn("clean", text.compact_key(r)), steps)


def country(values: DataFrame, raw: str, memory=None, names=None, codes=None, address_words=None, fuzzy: float | None = words.FUZZY_COUNTRY) -> DataFrame:
    """What only a resolver could tell is 'check'. Similar names are tried before address words; fuzzy None skips them."""
    spark = values.sparkSession
    if names is None or codes is None:
        names, codes = words.country_names(spark)
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    key = F.lower(clean)
    lookup = pairs(spark, names, lambda k: text.fold(F.lower(text.ustrip(k))), last_wins=True)
    prepared = values.withColumn("clean", text.clean_country(r))
    steps = [
        *memory_steps(memory_table(memory, spark), [r, text.ustrip(r), text.urstrip(r)], upper=True),
        Rule(None, clean == "", None),
        Rule(OUTLIER, clean.rlike(words.NOT_A_COUNTRY) | clean.rlike(r"^\d+$")),
        Table("MAP", lookup, key),
        Table("MAP", pairs(spark, {c: c for c in codes}), F.when(F.length(clean) == 2, clean)),
    ]
    first = resolve(prepared, steps, otherwise="check")
    pending = first.where("method = 'check'").select(F.lower("clean").alias("label")).distinct()
    out = first
    if fuzzy is not None:
        listed = lookup.select(F.col("k").alias("name"), F.xxhash64("k").alias("place"), "v")
        hits = best_names(pending, listed, 1, fuzzy).join(listed.select("name", "v"), "name").select(F.col("label").alias("like_key_"), F.col("v").alias("like_"))
        out = out.join(hits, (F.col("method") == "check") & (F.lower("clean") == F.col("like_key_")), "left")
    else:
        out = out.withColumn("like_", F.lit(None).cast("string"))
    out = longest_contained(out, F.lower("clean"), list((address_words or {}).items()))
    check = F.col("method") == "check"
    return out.select(
        *[F.col(f"`{c}`") for c in prepared.columns],
        F.when(check, F.coalesce("like_", "contained", "value")).otherwise(F.col("value")).alias("value"),
        F.when(check & F.col("like_").isNotNull(), "FUZZY").when(check & F.col("contained").isNotNull(), "ADDR").otherwise(F.col("method")).alias("method"),
    )


def looks_like_name(clean: Column, names: list[str]) -> Column:
    """At least two words, half of them (rounded down, one at least) first names."""
    parts = F.split(clean, " ")
    known = F.size(F.filter(parts, lambda w: w.isin(names))) if names else F.lit(0)
    return (F.size(parts) >= 2) & (known >= F.greatest(F.lit(1), F.floor(F.size(parts) / 2)))


def looks_like_date(clean: Column) -> Column:
    return F.lower(clean).rlike(r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}|[a-z]{3,4}[-/]\d{2,4})\b")


def nature(values: DataFrame, raw: str, memory=None, natures=None, direct=None, names=None) -> DataFrame:
    """Values without a deterministic answer stay null, for a resolver with the closed list of labels."""
    spark = values.sparkSession
    labels = list(words.flatten_categories(natures or words.NATURES))
    direct = direct if direct is not None else words.NATURE_DIRECT
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    bare = F.upper(text.ustrip(r))
    vague = [k for k, v in direct.items() if v is None]
    obvious = (F.length(clean) <= 1) | clean.rlike(r"^\d+$") | looks_like_date(clean) | looks_like_name(clean, names or [])
    steps = [
        Rule(None, bare.isin("", "NAN", "NONE", "NULL"), None),
        Rule(OUTLIER, bare == "NA"),
        *memory_steps(memory_table(memory, spark), [r, text.ustrip(r), text.urstrip(r), bare]),
        Rule("NOISE", (clean == "") | _is_in(clean, words.NATURE_HEADERS) | obvious),
        Table("MAP", pairs(spark, {x: x for x in labels}, text.clean_nature), clean),
        Table("MAP", pairs(spark, [(k, v) for k, v in direct.items() if v is not None]), clean),
        *([Rule("NOISE", _is_in(clean, vague))] if vague else []),
    ]
    return resolve(values.withColumn("clean", text.clean_nature(r)), steps, otherwise=None)


def correspondent(values: DataFrame, raw: str, memory=None, mapping: dict[str, str] | None = None) -> DataFrame:
    spark = values.sparkSession
    r, clean, mapping = F.col(f"`{raw}`"), F.col("clean"), mapping or {}
    steps = [
        Rule(None, clean == "", None),
        *memory_steps(memory_table(memory, spark), [r, text.urstrip(r), clean]),
        Table("MAP_CIBLE", target_index(spark, mapping, lambda k: F.upper(text.clean_correspondent(k))), F.upper(clean)),
        Table("MAP", pairs(spark, mapping), clean),
        Rule(OUTLIER, F.upper(clean) == "NA"),
    ]
    return resolve(values.withColumn("clean", text.clean_correspondent(r)), steps, otherwise=None)


def product(values: DataFrame, raw: str, memory=None, categories=None, aliases=None, noise=None) -> DataFrame:
    spark = values.sparkSession
    labels = list(words.flatten_categories(categories or words.PRODUCTS))
    aliases, noise = aliases if aliases is not None else words.PRODUCT_ALIASES, noise if noise is not None else words.PRODUCT_NOISE
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    steps = [
        Rule(None, clean == "", None),
        Rule(OUTLIER, clean == "NA"),
        *memory_steps(memory_table(memory, spark), [r, text.urstrip(r), clean]),
        Rule("NOISE", _is_in(clean, [n.upper() for n in noise])),
        Table("MAP", pairs(spark, aliases, text.clean_product), clean),
        Table("MAP_CIBLE", pairs(spark, {x: x for x in labels}, text.clean_product), clean),
    ]
    return resolve(values.withColumn("clean", text.clean_product(r)), steps, otherwise=None)


# ---- names of persons and companies ---------------------------------------------------------------------------


def obvious_noise(label: Column) -> Column:
    return (F.length(label) <= 1) | label.isin(words.OBVIOUS_NOISE) | label.rlike(r"(?U)^\d+$") | label.rlike(r"(?U)^[\W_]+$")


def local_class(label: Column, names: list[str] | None = None) -> tuple[Column, Column]:
    """Conditions for a private person and for a sole trader (ETS and a person's name); names are first names, none by default."""
    company = rf"\b(?:{'|'.join(sorted(words.COMPANY_WORDS, key=len, reverse=True))})\b"
    has_name = lambda c: F.arrays_overlap(F.split(c, " "), F.array(*[F.lit(n) for n in names])) if names else F.lit(False)
    person = ~label.rlike(company) & ~label.rlike(r"\bET\s+(?:FRERES|FILS)\b") & (F.size(F.split(label, " +")) >= 2) & has_name(label)
    rest = F.trim(F.regexp_replace(label, r"^(?:ETS|ETB|ETABLISSEMENTS?)\b\s*", ""))
    return person, (rest != "") & has_name(rest) & ~rest.rlike(company)


def local_steps(label: Column, names: list[str] | None = None) -> list[Rule]:
    person, trader = local_class(label, names)
    ets = label.rlike(r"^(?:ETS|ETB|ETABLISSEMENTS?)\b")
    return [Rule("PARTICULIER", person, label), Rule("ETS_PERSONNEL", ets & trader, label), Rule("ETS_OUTLIER", ets, OUTLIER)]


def tax_tables(base: DataFrame, order: str) -> dict[str, DataFrame]:
    """From NIF, RAISON_SOCIALE (and any order column): by valid id, by cleaned and by bare name; the first row in order wins."""
    rows = base.where(F.trim(F.coalesce("RAISON_SOCIALE", F.lit(""))) != "").select(F.col(order).alias("i"), F.trim("RAISON_SOCIALE").alias("v"), text.tax_id_padded(F.col("NIF")).alias("nif"))
    rows = rows.withColumn("clean", text.clean_label(F.col("v")))
    return {
        "id": first_per_key(rows.where(text.tax_id_valid(F.col("nif"))).select("i", F.col("nif").alias("k"), "v")),
        "clean": first_per_key(rows.select("i", F.col("clean").alias("k"), "v")),
        "bare": first_per_key(rows.select("i", text.hyper_normalised(F.col("clean")).alias("k"), "v")),
        "names": rows.where("clean <> ''").groupBy(F.col("clean").alias("name")).agg(F.min("i").alias("place"), F.min_by("v", "i").alias("v")),
    }


def public_tables(entities: DataFrame, order: str, short: str = "Short Name", full: str = "Raison social - Public Ent") -> dict[str, DataFrame]:
    """Public entities by full name and by short name (three letters or more, not denied)."""
    rows = entities.where(F.trim(F.coalesce(F.col(f"`{short}`"), F.lit(""))) != "").select(F.col(order).alias("i"), text.clean_label(F.col(f"`{short}`")).alias("v"), text.clean_label(F.col(f"`{full}`")).alias("full")).where("v <> ''")
    short_ok = (F.length("v") >= 3) & ~F.col("v").isin(words.SHORT_NAME_DENIED)
    named = first_per_key(rows.select("i", F.col("full").alias("k"), "v"))
    return {"full": named, "short": first_per_key(rows.where(short_ok).select("i", F.col("v").alias("k"), "v")), "names": named.select(F.col("k").alias("name"), F.xxhash64("k").alias("place"), "v")}


def public_entity(labels: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """k, v: cleaned labels that are a public entity: by full name, else by the first short name in them, else by a strong likeness."""
    label = cut(labels.select("label").distinct())
    exact = label.join(tables["full"], label["label"] == tables["full"]["k"]).select("label", "v", F.lit(0).alias("i"))
    token = first_token_hit(label, "label", tables["short"]).withColumn("i", F.lit(1))
    long_ = label.where(F.length("label") >= words.PUBLIC_LENGTH)
    alike = best_names(long_, tables["names"], 1, words.PUBLIC_MATCH).join(tables["names"].select("name", "v"), "name").select("label", "v", F.lit(2).alias("i"))
    return first_per_key(exact.unionByName(token).unionByName(alike).withColumnRenamed("label", "k"))


def to_public(resolved: DataFrame, tables: dict[str, DataFrame] | None) -> DataFrame:
    """Names found in the tax base that denote a public entity give way to its short name."""
    if tables is None:
        return resolved
    matched = F.col("method").isin("DGI_EXACT_NORM", "DGI_FUZZY_STRONG", "DGI_CLAUDE_ARBITRAGE") & (F.col("value") != OUTLIER)
    labels = resolved.where(matched).select("value").distinct().withColumn("label", text.clean_label(F.col("value")))
    public = labels.join(public_entity(labels.select("label"), tables), F.col("label") == F.col("k")).select(F.col("value").alias("official_"), F.col("v").alias("short_"))
    joined = resolved.join(public, matched & (F.col("value") == F.col("official_")), "left")
    hit = F.col("short_").isNotNull()
    return joined.withColumns({"value": F.when(hit, F.col("short_")).otherwise(F.col("value")), "method": F.when(hit, "PUBLIC_ENT").otherwise(F.col("method"))}).drop("official_", "short_")


def local_entity(values: DataFrame, raw: str, tax_id: str | None, base: DataFrame, entities: DataFrame | None = None, memory=None, mapping: dict[str, str] | None = None, cache: DataFrame | None = None, order: str = "place", arbitrator=None, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct (name, tax id) resolved against memory, mapping, the tax base and public entities.

    Returns the values with clean, value and method, and what was settled of each label that needed the tax base (k, v,
    method), for memory and cache. base and entities have an order column; cache is an earlier result (k, v, method) for the same
    base. Labels that are near to several names go to arbitrator, a function from their three nearest names (label, rank, name,
    score) to label, value, method, status (see operators.resolver.arbitrate); without one they are outliers of this run.
    """
    spark = values.sparkSession
    r, clean = F.col(f"`{raw}`"), F.col("clean")
    mapping = mapping or {}
    nif = text.tax_id(F.col(f"`{tax_id}`")) if tax_id else F.lit("")
    prepared = values.withColumns({"clean": text.clean_label(r), "nif_": nif})
    tax = tax_tables(base, order)
    none = spark.createDataFrame([], "k string, v string")
    known = public_tables(entities, order) if entities is not None else None
    public = public_entity(prepared.where("clean <> ''").select(F.col("clean").alias("label")), known) if known else none
    steps = [
        Rule(None, clean == "", None),
        *memory_steps(memory_table(memory, spark), [clean]),
        Table("MAP_CIBLE", first_per_key(pairs(spark, {v: v for v in mapping.values() if v != OUTLIER}).select(F.lit(0).alias("i"), text.clean_label(F.col("k")).alias("k"), "v")), clean),
        Table("MAP", pairs(spark, mapping), clean),
        Rule(OUTLIER, clean == "NA"),
        Table("NIF_EXACT", tax["id"], F.when(text.tax_id_valid(F.col("nif_")), F.col("nif_"))),
        Table("PUBLIC_ENT", public, clean),
        Rule(OUTLIER, obvious_noise(clean)),
        *local_steps(clean, names),
    ]
    first = cut(resolve(prepared, steps, otherwise="pending"))
    pending = cut(first.where("method = 'pending'").select(F.col("clean").alias("label")).distinct())
    cached = (cache if cache is not None else spark.createDataFrame([], "k string, v string, method string")).select(F.col("k").alias("label"), F.col("v").alias("value"), "method")
    cached = cached.join(pending, "label")
    fresh = pending.join(cached, "label", "left_anti").withColumn("bare", text.hyper_normalised(F.col("label")))
    exact = fresh.where("bare <> ''").join(tax["bare"], F.col("bare") == F.col("k")).select("label", F.col("v").alias("value"), F.lit("DGI_EXACT_NORM").alias("method"))
    exact = cut(exact)
    fuzzy = cut(fresh.select("label").join(exact, "label", "left_anti"))
    near = cut(best_names(fuzzy, tax["names"].select("name", F.col("place").cast("bigint").alias("place")), 3))
    tops = near.groupBy("label").agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("s1"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("s2"), F.max(F.when(F.col("rank") == 1, F.col("name"))).alias("name"))
    strong = (F.col("s1") >= words.STRONG_MATCH) & (F.col("s1") - F.coalesce("s2", F.lit(0.0)) >= words.MATCH_GAP)
    weak = F.coalesce(F.col("s1"), F.lit(0.0)) < words.NO_MATCH
    judged = fuzzy.join(tops, "label", "left").join(tax["names"].select("name", F.col("v").alias("official")), "name", "left")
    sure = judged.where(strong | weak).select("label", F.when(strong, F.col("official")).otherwise(OUTLIER).alias("value"), F.when(strong, "DGI_FUZZY_STRONG").otherwise("DGI_NO_MATCH").alias("method"))
    open_ = near.join(sure.select("label"), "label", "left_anti")
    if arbitrator is not None:
        told = arbitrator(open_).select("label", F.col("value").alias("name"), "method")
        told = told.join(tax["names"].select("name", "v"), "name", "left").select("label", F.coalesce("v", F.lit(OUTLIER)).alias("value"), "method")
    else:
        told = open_.select("label").distinct().select("label", F.lit(OUTLIER).alias("value"), F.lit(OUTLIER).alias("method"))
    settled = cut(to_public(cut(cached.unionByName(exact).unionByName(sure).unionByName(told)), known))
    out = first.join(settled.select(F.col("label").alias("label_"), F.col("value").alias("v_"), F.col("method").alias("m_")), (F.col("method") == "pending") & (F.col("clean") == F.col("label_")), "left")
    waits = F.col("method") == "pending"
    out = out.select(*[F.col(f"`{c}`") for c in values.columns], "clean", F.when(waits, F.coalesce("v_", F.lit(OUTLIER))).otherwise(F.col("value")).alias("value"), F.when(waits, F.coalesce("m_", F.lit(OUTLIER))).otherwise(F.col("method")).alias("method"))
    return out, settled.select(F.col("label").alias("k"), F.col("value").alias("v"), "method")


def foreign_entity(values: DataFrame, raw: str, entities: DataFrame | None = None, memory=None, mapping: dict[str, str] | None = None, order: str = "place", names: list[str] | None = None) -> DataFrame:
    """As far as it can be told without a resolver; the rest stays null."""
    spark = values.sparkSession
    r, clean, mapping = F.col(f"`{raw}`"), F.col("clean"), mapping or {}
    prepared = values.withColumn("clean", text.clean_label(r))
    none = spark.createDataFrame([], "k string, v string")
    public = public_entity(prepared.where("clean <> ''").select(F.col("clean").alias("label")), public_tables(entities, order)) if entities is not None else none
    steps = [
        Rule(None, clean == "", None),
        *memory_steps(memory_table(memory, spark), [clean]),
        Table("MAP_CIBLE", first_per_key(pairs(spark, {v: v for v in mapping.values() if v != OUTLIER}).select(F.lit(0).alias("i"), text.clean_label(F.col("k")).alias("k"), "v")), clean),
        Table("MAP", pairs(spark, mapping), clean),
        Rule(OUTLIER, clean == "NA"),
        Table("PUBLIC_ENT", public, clean),
        Rule(OUTLIER, obvious_noise(clean)),
        *local_steps(clean, names),
    ]
    return resolve(prepared, steps, otherwise=None)


# ---- from distinct values to rows -----------------------------------------------------------------------------

#: How each kind of field cleans a raw value: the key under which corrections are remembered.
CLEANERS = {
    "currency": text.clean_currency, "message_type": text.compact_key, "payment_mode": text.compact_key, "country": text.clean_country, "nature": text.clean_nature,
    "correspondent": text.clean_correspondent, "product": text.clean_product, "local_entity": text.clean_label, "foreign_entity": text.clean_label,
}
RESOLVERS = {"currency": currency, "message_type": message_type, "payment_mode": payment_mode, "country": country, "nature": nature, "correspondent": correspondent, "product": product, "foreign_entity": foreign_entity}


def field(df: DataFrame, kind: str, raw: str, out: str, witness: str | None = None, categories: dict[str, list[str]] | None = None, resolver=None, **options) -> DataFrame:
    """df plus {raw}_clean, out, {raw}_method, {raw}_check (and {raw}_Categorie): one categorical field resolved.

    Distinct values are resolved and joined back; resolver, if given, is asked about what is left (see operators.resolver).
    What nobody resolves is an OUTLIER; the no-activity rule comes last. Null and blank values are left to it.
    """
    resolved = RESOLVERS[kind](distinct_values(df, raw), raw, **options)
    if resolver is not None:
        resolved = resolver(resolved, raw)
    left_open = (F.col("method").isNull() & (F.col("clean") != "")) | (F.col("method") == "check")
    if kind not in ("currency", "message_type", "payment_mode"):
        resolved = resolved.withColumns({"value": F.when(left_open, OUTLIER).otherwise(F.col("value")), "method": F.when(left_open, OUTLIER).otherwise(F.col("method"))})
    method = f"{raw}_method"
    rows = attach(df, resolved, [raw], out, method, {"clean": f"{raw}_clean"}).withColumn(f"{raw}_clean", F.coalesce(f"{raw}_clean", F.lit("")))
    if witness:
        rows = (apply_country_rule if kind == "country" else apply_na_rule)(rows, raw, witness, out, method)
    rows = rows.withColumn(f"{raw}_check", F.coalesce(F.col(f"`{out}`") == OUTLIER, F.lit(False)))
    if categories is not None:
        known = words.flatten_categories(categories)
        table = reduce(lambda c, kv: F.when(F.col(f"`{out}`") == kv[0], kv[1]).otherwise(c), known.items(), F.lit(""))
        rows = rows.withColumn(f"{raw}_Categorie", table)
    return rows


def entity_field(df: DataFrame, raw: str, out: str, tax_id: str | None, base: DataFrame, witness: str | None = None, settled: list | None = None, **options) -> DataFrame:
    """df plus the columns of field() for a local entity, resolved by name and tax id together. settled gets what needed the base (k, v, method)."""
    keys = [raw, *([tax_id] if tax_id and tax_id in df.columns else [])]
    resolved, found = local_entity(distinct_values(df, *keys), raw, tax_id if tax_id in keys else None, base, **options)
    if settled is not None:
        settled.append(found)
    method = f"{raw}_method"
    rows = attach(df, resolved, keys, out, method, {"clean": f"{raw}_clean"}).withColumn(f"{raw}_clean", F.coalesce(f"{raw}_clean", F.lit("")))
    if witness:
        rows = apply_na_rule(rows, raw, witness, out, method)
    return rows.withColumn(f"{raw}_check", F.coalesce(F.col(f"`{out}`") == OUTLIER, F.lit(False)))
