"""Validated values that win over everything, corrections by hand, and mapping tables that only grow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import correction_label, ustrip
from .cascade import OUTLIER, first_per_key


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing with new's rows in place of those with their keys."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def correction_rows(sheet: DataFrame, clean: Column, preserve_case: bool = False) -> DataFrame:
    """Memory entries of correction rows (Champ, Input, Label_Attendu): each input under its clean, raw and upper-case form.

    Labels are collapsed and put in upper case, canonical mixed case included, unless preserve_case. Incomplete rows go.
    """
    raw = ustrip(F.col("Input").cast("string"))
    label = F.col("Label_Attendu").cast("string")
    label = ustrip(F.regexp_replace(label, r"(?U)\s+", " ")) if preserve_case else correction_label(label)
    whole = (F.coalesce(raw, F.lit("")) != "") & (F.coalesce(label, F.lit("")) != "")
    return sheet.where(whole).select("Champ", F.explode(F.array_distinct(F.array(clean, raw, F.upper(raw)))).alias("k"), label.alias("v")).where("k <> ''")


def correction_report(sheet: DataFrame, fields: list[str]) -> DataFrame:
    """Per field of a sheet: rows, incomplete rows, and whether the field is one that takes corrections."""
    incomplete = (ustrip(F.coalesce(F.col("Input"), F.lit(""))) == "") | (ustrip(F.coalesce(F.col("Label_Attendu"), F.lit(""))) == "")
    return sheet.groupBy("Champ").agg(F.count("*").alias("n_rows"), F.sum(incomplete.cast("long")).alias("n_incomplete")).withColumn("known", F.col("Champ").isin(fields))


def append_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """history plus new's rows (date, champ, input, label_attendu) whose triple it lacks; of equal new ones the earliest."""
    triple = ["champ", "input", "label_attendu"]
    fresh = new.groupBy(*triple).agg(F.min("date").alias("date")).join(history.select(*triple), triple, "left_anti")
    return history.unionByName(fresh.select(*history.columns))


def cumulative_mapping(sources: list[DataFrame], raw: str, out: str) -> DataFrame:
    """The union of tables k, v, later ones winning, as a mapping table."""
    tagged = reduce(lambda a, b: a.unionByName(b), [s.select("k", "v", F.lit(i).alias("i")) for i, s in enumerate(sources)])
    return first_per_key(tagged, last_wins=True).select(F.col("k").alias(raw), F.col("v").alias(out)).orderBy(F.asc_nulls_last(out), F.asc_nulls_last(raw))


def cacheable_matches(resolved: DataFrame) -> DataFrame:
    """Resolutions against the tax base that may be kept for a base with the same fingerprint."""
    return resolved.where(F.col("method").isin("DGI_EXACT_NORM", "DGI_FUZZY_STRONG", "DGI_NO_MATCH")).select(F.col("clean").alias("k"), F.col("value").alias("v"), "method").distinct()


def base_fingerprint(base: DataFrame, name: str = "RAISON_SOCIALE") -> str:
    """A digest of the base's names that doesn't depend on their order: count and two sums of hashes."""
    row = base.agg(F.count("*"), F.sum(F.xxhash64(name).cast("decimal(38,0)")), F.sum(F.xxhash64(F.reverse(name)).cast("decimal(38,0)"))).first()
    import hashlib

    return hashlib.sha256("|".join(map(str, row)).encode()).hexdigest()[:32]


def outlier_origin(outliers: DataFrame, memory: DataFrame, static: DataFrame, value: str) -> DataFrame:
    """Distinct outlier values with origin: cache, static or never_seen."""
    distinct = outliers.select(value).where(F.col(value).isNotNull()).distinct()
    marked = lambda t, name: t.select(F.col("k").alias(value), F.lit(True).alias(name)).distinct()
    joined = distinct.join(marked(memory, "in_memory"), value, "left").join(marked(static, "in_static"), value, "left")
    return joined.select(value, F.when(F.col("in_memory"), "cache").when(F.col("in_static"), "static").otherwise("never_seen").alias("origin"))


__all__ = ["OUTLIER", "append_history", "base_fingerprint", "cacheable_matches", "correction_report", "correction_rows", "cumulative_mapping", "outlier_origin", "upsert"]
