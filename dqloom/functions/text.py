"""Cleaning of dirty text values as Column expressions.

Everything stays in the JVM but for clean_label, whose rewriting of acronyms needs callbacks; it
is a pandas UDF and meant for distinct values.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the cleaning rules.
EMPTY_WORDS = ["nan", "none", "null"]
ACRONYM_SEGMENTS = r"\b[A-Z]+(?:\.[A-Z]+)+\b"
LONE_LETTERS = r"\b[A-Z](?:\s+[A-Z])+\b"
EXPORT_ARTEFACTS = r"(?i)_x000d_|\\r|\\n|\r\n|\r|\n"
NAME_PARTICLES = (("O", "OULD "), ("MT", "MINT "), ("BT", "BINT "))
CURRENCY_WORDS = r"\b(?:USD|EUR|MRU|MRO|DOLLARS?|EUROS?)\b"
SPECIAL_SIGNS = r"""[*#@^~`|\\,;:.()\[\]{}"'/]"""
COUNTRY_SIGNS = r"""[.,/\\?;:!#@%&*()\[\]+=_~^`|<>'"°’‘–—«»]+"""
MONTHS = "jan|fev|mar|avr|mai|jun|jul|aou|sep|oct|nov|dec|feb|apr|aug"
DATES = (
    r"(?iU)\b(?:\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"
    rf"|\d{{1,2}}[-/](?:{MONTHS})[a-z]*[-/]?\d{{0,4}}|(?:{MONTHS})[a-z]*[-/\s]\d{{2,4}}|\d{{1,2}}-\d{{2}})\b"
)


def _accent_table() -> tuple[str, str]:
    """Letters up to U+1EFF that are one letter and accents, and those letters."""
    letters, plain = [], []
    for code in range(0xC0, 0x1F00):
        parts = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in parts if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code) and parts != chr(code):
            letters.append(chr(code))
            plain.append(base)
    return "".join(letters), "".join(plain)


ACCENTED, UNACCENTED = _accent_table()


def ustrip(c: Column) -> Column:
    """Without white space of any kind at its ends (trim only knows blanks)."""
    return F.regexp_replace(c, r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def urstrip(c: Column) -> Column:
    """Without white space of any kind at its end."""
    return F.regexp_replace(c, r"(?U)[\s\p{Z}]+$", "")


def squeeze(c: Column, to: str = " ") -> Column:
    return F.regexp_replace(c, r"(?U)[\s\p{Z}]+", to)


def fold(c: Column) -> Column:
    """Without accents: composed letters become plain ones, combining marks go."""
    return F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"\p{Mn}", "")


def unless_empty(c: Column, otherwise: Column) -> Column:
    """Empty text where c is null, blank or a word for nothing, else otherwise."""
    bare = ustrip(c)
    return F.when(c.isNull() | (bare == "") | F.lower(bare).isin(EMPTY_WORDS), F.lit("")).otherwise(otherwise)


def clean_currency(c: Column) -> Column:
    """A code without trailing .0, blanks and case."""
    return unless_empty(c, F.upper(squeeze(F.regexp_replace(ustrip(c), r"\.0+$", ""), "")))


def before_parenthesis(c: Column) -> Column:
    return ustrip(F.substring_index(c, "(", 1))


def alnum_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]", "")


def compact_key(c: Column) -> Column:
    """Without any white space, in upper case: the key of message types and payment modes."""
    return unless_empty(c, F.upper(squeeze(c, "")))


def clean_correspondent(c: Column) -> Column:
    """White space collapsed, case kept."""
    return unless_empty(c, squeeze(ustrip(c)))


def clean_product(c: Column) -> Column:
    """Upper case without accents, white space collapsed."""
    return unless_empty(c, F.upper(ustrip(squeeze(fold(c)))))


def clean_country(c: Column) -> Column:
    """Without dates and signs, in upper case without accents."""
    bare = F.regexp_replace(F.regexp_replace(ustrip(c), DATES, " "), COUNTRY_SIGNS, " ")
    return unless_empty(c, fold(F.upper(ustrip(F.regexp_replace(bare, r"(?U)\s{2,}", " ")))))


def clean_nature(c: Column) -> Column:
    """Words of two letters or more in upper case, without accents, leading codes and code-like tokens."""
    words = F.regexp_replace(ustrip(F.regexp_replace(F.upper(fold(c)), r"(?U)[^A-Z0-9\s]", " ")), r"^\d{1,5}[-\s]+", "")
    kept = F.filter(F.split(words, r"(?U)\s+"), lambda w: (F.length(w) >= 2) & ~w.rlike(r"^[\dA-Z]{1,3}\d+[\dA-Z]*$"))
    return unless_empty(c, F.array_join(kept, " "))


def clean_label_text(value: str | None) -> str:
    """A name in upper case: accents, export artefacts, currencies and signs gone, acronyms joined."""
    if value is None or value != value or not (text := str(value).strip()) or text.lower() in EMPTY_WORDS:
        return ""
    text = re.sub(EXPORT_ARTEFACTS, " ", text).upper()
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    for short, full in NAME_PARTICLES:
        text = re.sub(rf"\b{short}\s*[/.]\s*", full, text)
    text = re.sub(ACRONYM_SEGMENTS, lambda m: m[0].replace(".", " " if re.search("[A-Z]{2}", m[0]) else ""), text)
    text = re.sub(LONE_LETTERS, lambda m: m[0].replace(" ", ""), text)
    for pattern in (CURRENCY_WORDS, SPECIAL_SIGNS):
        text = re.sub(pattern, " ", text)
    return re.sub(r"\s+", " ", re.sub("-{2,}", "-", text)).strip(" -")


@F.pandas_udf(T.StringType())
def clean_label(values: pd.Series) -> pd.Series:
    return values.map(clean_label_text)


def hyper_normalised(label: Column) -> Column:
    """Only the letters and digits of a cleaned label."""
    return F.regexp_replace(label, "[^A-Z0-9]", "")


def tax_id(c: Column) -> Column:
    """The digits; null counts as none."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\D", "")


def tax_id_padded(c: Column) -> Column:
    """At least eight digits; longer ones stay (lpad alone would cut them)."""
    digits = tax_id(c)
    return F.when(F.length(digits) >= 8, digits).otherwise(F.lpad(digits, 8, "0"))


def tax_id_valid(digits: Column) -> Column:
    """Eight digits that aren't all the same."""
    return (F.length(digits) == 8) & (F.length(F.replace(digits, F.substring(digits, 1, 1), F.lit(""))) > 0)


def correction_label(c: Column) -> Column:
    return F.upper(squeeze(ustrip(c)))


def grouped_int(c: Column) -> Column:
    """1234567 as 1 234 567."""
    return F.replace(F.format_number(c.cast("long"), 0), F.lit(","), F.lit(" "))


def percent_text(c: Column) -> Column:
    """12.34 as 12,3 %."""
    return F.concat(F.replace(F.format_string("%.1f", c.cast("double")), F.lit("."), F.lit(",")), F.lit(" %"))


def duration_text(seconds: float) -> str:
    return f"{int(seconds) // 60:02d}:{int(seconds) % 60:02d}"


def report_cell(c: Column, longest: int = 90, token: int = 28) -> Column:
    """A value fit for a table cell: escapes and line breaks gone, cut at longest characters, long tokens split."""
    text = ustrip(squeeze(F.regexp_replace(c.cast("string"), "_x[0-9A-Fa-f]{4}_", " ")))
    text = F.when(F.length(text) > longest, F.concat(urstrip(F.substring(text, 1, longest)), F.lit("…"))).otherwise(text)
    return F.regexp_replace(text, rf"(\S{{{token}}})(?=\S)", "$1 ")
