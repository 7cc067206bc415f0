"""Rules for values that say there was no activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import is_token, says, tagged, to_number
from ..functions.text import ustrip

# Fixed values of the rules.
EMPTY_TOKENS = ["", "NAN", "NONE", "NULL"]
EMPTY_WITNESSES = ["na", "nan", "none", "null", "", "string"]
EPSILON = 1e-9


def apply_na_rule(df: DataFrame, raw: str, witness: str, value: str, method: str) -> DataFrame:
    """NA in a field and in its witness is NA; NA alone, or nothing, is an OUTLIER; an OUTLIER keeps its method.

    Without the witness column nothing changes.
    """
    if witness not in df.columns:
        return df
    na, witness_na = is_token(F.col(f"`{raw}`"), ["NA"]), is_token(F.col(f"`{witness}`"), ["NA"])
    empty = is_token(F.col(f"`{raw}`"), EMPTY_TOKENS)
    v, m = F.col(f"`{value}`"), F.col(f"`{method}`")
    kept = F.when(F.coalesce(m, F.lit("")) == "", F.lit("OUTLIER")).otherwise(m)
    new_value = F.when(na & witness_na, "NA").when(na | empty | tagged(v), "OUTLIER").otherwise(v)
    new_method = F.when(na & witness_na, "NA").when(na | empty, "OUTLIER").when(tagged(v), kept).otherwise(m)
    return df.withColumns({value: new_value, method: new_method})


def apply_country_rule(df: DataFrame, raw: str, witness: str, value: str, method: str) -> DataFrame:
    """The country's own rule: no country and no reference is NoAs; NA with a reference is Namibia's code."""
    if witness not in df.columns:
        return df
    text = F.lower(ustrip(F.coalesce(F.col(f"`{raw}`").cast("string"), F.lit(""))))
    blank = F.lower(ustrip(F.coalesce(F.col(f"`{witness}`").cast("string"), F.lit("")))).isin(EMPTY_WITNESSES)
    none, na, written_out = text.isin("", "nan", "none", "null"), text == "na", text.isin("noas", "naos")
    v, m = F.col(f"`{value}`"), F.col(f"`{method}`")
    no_activity = (none | na | written_out) & blank
    outlier = none | written_out | tagged(v)
    new_value = F.when(no_activity, "NoAs").when(na, "NA").when(outlier, "OUTLIER").otherwise(v)
    new_method = F.when(no_activity, "NoAs").when(na, "MAP").when(outlier, "OUTLIER").otherwise(m)
    return df.withColumns({value: new_value, method: new_method})


def zero(c: Column) -> Column:
    """Whether a number is there and 0 but for floating noise."""
    return F.coalesce(F.abs(c) <= EPSILON, F.lit(False))


def add_global_witness(df: DataFrame, ids: list[str], amounts: list[str], name: str) -> DataFrame:
    """df plus a witness: NA where all ids say NA and all amounts are zero, else empty. Missing columns: not NA."""
    if any(c not in df.columns for c in [*ids, *amounts]):
        return df.withColumn(name, F.lit(""))
    idle = F.lit(True)
    for c in ids:
        idle = idle & says(F.col(f"`{c}`"), "NA")
    for c in amounts:
        idle = idle & zero(to_number(df, c))
    return df.withColumn(name, F.when(idle, "NA").otherwise(""))
