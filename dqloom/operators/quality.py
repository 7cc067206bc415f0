"""Quality indicators: of a field, of a run and of the history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import KNOWN_METHODS, KNOWN_NOISE_METHODS
from ..functions.parse import any_of, percent, tagged


def _total(cond: Column) -> Column:
    return F.coalesce(F.sum(cond.cast("long")), F.lit(0))


def mapping_pairs(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Distinct raw -> value without outliers, by value and raw."""
    return df.where(~tagged(F.col(out))).select(raw, out).distinct().orderBy(F.asc_nulls_last(out), F.asc_nulls_last(raw))


def classification(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Distinct raw -> value with outliers, without null raw values."""
    return df.select(raw, out).where(F.col(raw).isNotNull()).distinct().orderBy(F.asc_nulls_last(out), F.asc_nulls_last(raw))


def outlier_stats(df: DataFrame, raw: str, out: str, bank: str = "RefBanque") -> DataFrame:
    """Outliers per bank and raw value with the bank's totals; without a bank column, with the totals of all.

    Null banks and raw values don't count as groups. One pre-aggregation by (bank, raw, outlier) carries everything, so a
    hot bank is never gathered in one task.
    """
    keys = [bank] if bank in df.columns else []
    cells = df.groupBy(*keys, raw, tagged(F.col(out)).alias("is_out")).agg(F.count("*").alias("n"))
    totals = cells.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("is_out"), F.col("n"))), F.lit(0)).alias("Nombre_total_OUTLIERS"),
        F.coalesce(F.sum(F.when(~F.col("is_out"), F.col("n"))), F.lit(0)).alias("Nombre_total_CLEAN_VALUES"),
        F.sum("n").alias("Nombre_total_LIGNES"),
    )
    counts = cells.where(F.col("is_out") & F.col(raw).isNotNull()).select(*keys, raw, F.col("n").alias("Nombre_OUTLIERS"))
    joined = counts.join(totals, keys) if keys else counts.join(F.broadcast(totals))  # one row of totals
    shown = joined.select(*keys, raw, "Nombre_OUTLIERS", percent(F.col("Nombre_OUTLIERS"), F.col("Nombre_total_LIGNES")).alias("Ratio_OUTLIERS"), "Nombre_total_OUTLIERS", "Nombre_total_CLEAN_VALUES", "Nombre_total_LIGNES")
    return shown.orderBy(*keys, raw)


def field_stats(df: DataFrame, raw: str, out: str) -> DataFrame:
    """One row: rows, distinct values, normalised ones, outlier rows and the rates."""
    bad = tagged(F.col(out))
    row = df.agg(F.count("*").alias("n_rows"), F.countDistinct(raw).alias("n_distinct_total"), F.countDistinct(F.when(~bad, F.col(raw))).alias("n_distinct_normalized"), _total(bad).alias("n_outlier_rows"))
    return row.withColumns({"taux_normalisation_pct": percent(F.col("n_distinct_normalized"), F.col("n_distinct_total")), "taux_outliers_pct": percent(F.col("n_outlier_rows"), F.col("n_rows"))})


def outliers_by_method(df: DataFrame, raw: str, out: str, method: str | None = None) -> DataFrame:
    """Per method: outlier rows and distinct raw values; and whether the method is one of known noise."""
    method = method or f"{raw}_method"
    return df.where(tagged(F.col(out)) & F.col(method).isNotNull()).groupBy(F.col(method).alias("method")).agg(F.count("*").alias("n_rows"), F.countDistinct(raw).alias("n_distinct")).withColumn("known_noise", F.col("method").isin(KNOWN_NOISE_METHODS))


def known_noise_split(df: DataFrame, raw: str, out: str) -> DataFrame:
    by = outliers_by_method(df, raw, out)
    return by.agg(F.coalesce(F.sum(F.when(F.col("known_noise"), F.col("n_distinct"))), F.lit(0)).alias("known"), F.coalesce(F.sum(F.when(~F.col("known_noise"), F.col("n_distinct"))), F.lit(0)).alias("new"))


def new_values(df: DataFrame, raw: str, out: str, order: list[str], method: str | None = None) -> DataFrame:
    """One row: values whose first row was resolved by none of the methods known before the run; a null value counts as one."""
    method = method or f"{raw}_method"
    first = df.groupBy(raw).agg(F.min_by(F.struct(F.col(out).alias("o"), F.col(method).alias("m")), F.struct(*order)).alias("f")).select("f.o", "f.m")
    new = ~F.coalesce(F.col("m").isin(KNOWN_METHODS), F.lit(False))
    return first.agg(_total(new).alias("n_new_distinct"), _total(new & ~tagged(F.col("o"))).alias("n_new_normalized"), _total(new & tagged(F.col("o"))).alias("n_new_outliers"))


def cumulative_stats(tables: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """One row over mapping tables (table, raw, out): distinct, normalised, already clean, cleaned and outlier values with rates."""
    parts = [t.select(F.col(raw).cast("string").alias("raw"), F.col(out).alias("out")) for t, raw, out in tables]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    good = ~tagged(F.col("out"))
    one = rows.agg(F.count("*").alias("n_distinct_total"), _total(good).alias("n_distinct_normalized"), _total(good & F.col("raw").eqNullSafe(F.col("out"))).alias("n_already_clean"))
    n = F.col("n_distinct_total")
    return one.withColumns({"n_cleaned": F.col("n_distinct_normalized") - F.col("n_already_clean"), "n_outliers": n - F.col("n_distinct_normalized")}).withColumns(
        {"already_clean_pct": percent(F.col("n_already_clean"), n), "cleaned_pct": percent(F.col("n_cleaned"), n), "outliers_pct": percent(F.col("n_outliers"), n)}
    )


def row_flags(df: DataFrame, outs: list[str]) -> Column:
    """Whether a row has an outlier or fails a check (any column *_row_conforme)."""
    checks = [~F.coalesce(F.col(f"`{c}`").cast("boolean"), F.lit(True)) for c in df.columns if c.endswith("_row_conforme")]
    return any_of([*(tagged(F.col(f"`{o}`")) for o in outs if o in df.columns), *checks])


def run_indicators(df: DataFrame, outs: list[str]) -> DataFrame:
    """One row: rows, rows with an outlier, conformity and outlier rates."""
    one = df.agg(F.count("*").alias("n_rows"), _total(row_flags(df, outs)).alias("n_outlier_rows"))
    good = percent(F.col("n_rows") - F.col("n_outlier_rows"), F.col("n_rows"))
    return one.withColumns({"taux_conformite_pct": good, "taux_outliers_pct": percent(F.col("n_outlier_rows"), F.col("n_rows"))})


def outliers_by_field(df: DataFrame, fields: dict[str, str], anomalies: DataFrame | None = None) -> DataFrame:
    """champ, n: outlier rows of each field and errors of each rule. One pass over the rows for all fields."""
    counts = df.agg(*[_total(tagged(F.col(f"`{o}`"))).alias(f"c{i}") for i, o in enumerate(fields.values())])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("champ"), F.col(f"c{i}").alias("n")) for i, name in enumerate(fields)])).alias("x")).select("x.champ", "x.n")
    if anomalies is None:
        return stacked
    return stacked.unionByName(anomalies.where("Severity = 'ERROR' and Rule is not null").groupBy(F.col("Rule").alias("champ")).agg(F.count("*").alias("n")))


def outliers_by_bank(df: DataFrame, outs: list[str], anomalies: DataFrame | None = None, bank: str = "RefBanque") -> DataFrame:
    """bank, n: rows with an outlier plus errors, both counted; null banks don't count."""
    parts = df.where(row_flags(df, outs)).groupBy(bank).agg(F.count("*").alias("n"))
    if anomalies is not None and bank in anomalies.columns:
        parts = parts.unionByName(anomalies.where("Severity = 'ERROR'").groupBy(bank).agg(F.count("*").alias("n")))
    return parts.where(F.col(bank).isNotNull()).groupBy(bank).agg(F.sum("n").alias("n"))


def mean_rate(stats: list[DataFrame]) -> DataFrame:
    """The mean of the fields' normalisation rates."""
    rows = reduce(lambda a, b: a.unionByName(b), [s.select("taux_normalisation_pct") for s in stats])
    return rows.agg(F.bround(F.avg("taux_normalisation_pct"), 2).alias("taux_normalisation_pct"))


def anomaly_counts(df: DataFrame, anomalies: DataFrame, flag: str) -> DataFrame:
    """One row: errors, warnings and the share of rows without violation."""
    by = anomalies.agg(_total(F.col("Severity") == "ERROR").alias("n_anomalies_error"), _total(F.col("Severity") == "WARNING").alias("n_anomalies_warning"))
    rows = df.agg(F.count("*").alias("n_rows"), _total(F.col(flag)).alias("good"))
    return rows.join(F.broadcast(by)).select("n_rows", "n_anomalies_error", "n_anomalies_warning", percent(F.col("good"), F.col("n_rows")).alias("taux_conformite_pct"))


def dominance(df_rows: int, anomalies: DataFrame, share: float = 0.2) -> DataFrame:
    """Rule, n and whether it hits more than share of the rows."""
    return anomalies.groupBy("Rule").agg(F.count("*").alias("n")).withColumn("dominant", F.col("n") > share * max(1, df_rows))


def bank_detail(outlier_tables: dict[str, tuple[DataFrame, str]], anomalies: list[tuple[DataFrame, str]], labels: dict[str, str], bank: str = "RefBanque") -> DataFrame:
    """bank, champ, valeur, n: outlier values per field, and ids of rows in error per rule."""
    parts = [t.select(F.col(bank).cast("string").alias("bank"), F.lit(labels.get(name, name)).alias("champ"), F.col(raw).cast("string").alias("valeur"), F.col("Nombre_OUTLIERS").cast("long").alias("n")) for name, (t, raw) in outlier_tables.items() if bank in t.columns]
    shown = reduce(lambda c, kv: F.when(F.col("Rule") == kv[0], kv[1]).otherwise(c), labels.items(), F.col("Rule"))
    for table, number in anomalies:
        err = table.where(F.col("Severity") == "ERROR").where(F.col(bank).isNotNull() & F.col(number).isNotNull())
        parts.append(err.groupBy(bank, "Rule", number).agg(F.count("*").alias("n")).select(F.col(bank).cast("string").alias("bank"), shown.alias("champ"), F.col(number).cast("string").alias("valeur"), "n"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def top_banks(detail: DataFrame, most: int = 100) -> DataFrame:
    """bank, n and percent of all, the most affected ones first."""
    per = detail.groupBy("bank").agg(F.sum("n").alias("n"))
    whole = per.agg(F.sum("n").alias("whole"))
    ranked = per.join(F.broadcast(whole)).select("bank", "n", F.bround(100.0 * F.col("n") / F.greatest(F.col("whole"), F.lit(1)), 1).alias("pct"))
    ranked = ranked.orderBy(F.desc("n"), "bank")
    return ranked.limit(most) if most else ranked


def field_synthesis(by_field: DataFrame, rows: list[str], labels: dict[str, str]) -> DataFrame:
    """The listed labels in order with the counts of the fields and rules they stand for, zero where none."""
    spark = by_field.sparkSession
    listed = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "place int, label string")
    names = spark.createDataFrame(list(labels.items()) or [("", "")], "champ string, label string")
    counted = by_field.join(F.broadcast(names), "champ").groupBy("label").agg(F.sum("n").alias("n"))
    whole = by_field.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("whole"))
    joined = listed.join(counted, "label", "left").join(F.broadcast(whole))
    n = F.coalesce("n", F.lit(0))
    return joined.select("place", "label", n.alias("n"), F.bround(100.0 * n / F.greatest(F.col("whole"), F.lit(1)), 1).alias("pct")).orderBy("place")


def mail_counters(news: list[DataFrame], numeric_errors: int = 0) -> DataFrame:
    """Sums of the fields' new values for the notice of a run."""
    rows = reduce(lambda a, b: a.unionByName(b), news)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_new_distinct", "n_new_normalized", "n_new_outliers")]).withColumn("n_numeric_errors", F.lit(numeric_errors).cast("long"))


