"""License scans by canonical digest lookup, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh
from .license_texts import KNOWN

#: Spellings that license matching treats as the same word.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("modelled", "modeled"), ("noncommercial", "non commercial"), ("organisation", "organization"), ("owner", "holder"),
    ("practise", "practice"), ("programme", "program"), ("recognised", "recognized"), ("sublicence", "sublicense"), ("sub license", "sublicense"), ("whilst", "while"), ("wilful", "willful"),
)
#: A line that says who holds the copyright since when, behind comment signs or not; never one of a license's own sentences.
COPYRIGHT_LINE = (
    r"(?mi)^[ \t\f\r#*/;%!-]*(?:copyright[ \t:]*(?:\(c\)|©|\d{4}|[<\[{])[^\n]{0,160}"
    r"|(?:\(c\)|©)[ \t]*(?:copyright[ \t]*)?\d{4}[^\n]{0,160}|all rights reserved\.?[ \t\f\r]*)$"
)
KNOWN_MOST = 10_000  # rows of the known table that may be broadcast


def canonical(text: Column) -> Column:
    """Lower case, without the lines of copyright holders, words joined by one blank, equivalent spellings made one."""
    words = F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")), r"[^\p{L}\p{N}]+", "  ")
    spelt = reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]} ".replace(" ", "  ")[1:-1]), F.lit(f" {pair[1]} ".replace(" ", "  ")[1:-1])), SPELLINGS, F.concat(F.lit("  "), words, F.lit("  ")))
    return F.trim(F.regexp_replace(spelt, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_table(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_id and digest of each known text; of equal digests the first id in order stays."""
    rows = spark.createDataFrame(known or KNOWN, "license_id string, body string")
    return rows.groupBy(digest(F.col("body")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, text_digest, license_id (of the entire text, or null), n_license_lines, line_licenses.

    The entire text's digest is hash-joined to the known digests; each line is looked up the same way, so a
    notice inside other prose is found too. line_licenses has the ids found in lines, distinct, sorted and
    joined by commas (empty if none). Null and empty texts match nothing; long texts are taken whole; repeated rows
    give repeated results; an empty table an empty one; other columns don't matter. known has distinct digests;
    up to KNOWN_MOST rows it is broadcast, beyond that the lines are joined by a shuffle of the rows that match.
    """
    spark = docs.sparkSession
    known = known if known is not None else known_table(spark)
    row = fresh(docs.columns, "row_")
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    listed = known.select("digest", "license_id").limit(KNOWN_MOST + 1).collect()
    if len(listed) <= KNOWN_MOST:
        table = F.create_map(*[F.lit(x) for r in listed for x in (r.digest, r.license_id)]) if listed else F.create_map().cast("map<string,string>")
        lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.get(F.array(table[digest(line)]), F.lit(0))), lambda x: x.isNotNull())
        found = source.select("key", digest(F.col("text")).alias("digest"), lines.alias("found"))
        joined = found.join(F.broadcast(known), "digest", "left")
    else:
        place = source.withColumn(row, F.monotonically_increasing_id())
        lines = place.select(row, F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).select(row, digest(F.col("line")).alias("digest"))
        hits = lines.join(known, "digest").groupBy(row).agg(F.collect_list("license_id").alias("found"))
        joined = place.select(row, "key", digest(F.col("text")).alias("digest")).join(hits, row, "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>"))).join(known, "digest", "left")
    return joined.select(
        F.col("key").alias(key), F.col("digest").alias("text_digest"), "license_id",
        F.size("found").cast("long").alias("n_license_lines"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_licenses"),
    )


def canonical_sql(text: str) -> str:
    """canonical() in DuckDB's SQL; lines of holders are told by their parts."""
    line = "ltrim(lower(l), ' ' || chr(9) || chr(12) || chr(13) || '#*/;%!-')"
    rest = f"ltrim({line}[10:], ' ' || chr(9) || ':')"
    sign = f"CASE WHEN starts_with({line}, '(c)') THEN ltrim({line}[4:], ' ' || chr(9)) WHEN starts_with({line}, '©') THEN ltrim({line}[2:], ' ' || chr(9)) END"
    year = f"(CASE WHEN starts_with({sign}, 'copyright') THEN ltrim(({sign})[10:], ' ' || chr(9)) ELSE {sign} END)"
    since = f"coalesce(regexp_matches({year}[1:4], '^[0-9]{{4}}$') AND length({year}) <= 164, false)"
    holder = f"""(starts_with({line}, 'copyright') AND (starts_with({rest}, '(c)') AND length({rest}) <= 163 OR regexp_matches({rest}[1:4], '^[0-9]{{4}}$') AND length({rest}) <= 164 OR {rest}[1] IN ('©', '<', '[', '{{') AND length({rest}) <= 161)
      OR {since} OR rtrim({line}, ' ' || chr(9) || chr(12) || chr(13)) IN ('all rights reserved', 'all rights reserved.'))"""
    kept = f"array_to_string([CASE WHEN {holder} THEN '' ELSE l END FOR l IN string_split(coalesce({text}, ''), chr(10))], chr(10))"
    out = f"regexp_replace(lower({kept}), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')"
    out = f"('  ' || {out} || '  ')"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{f' {a} '.replace(' ', '  ')[1:-1]}', '{f' {b} '.replace(' ', '  ')[1:-1]}')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def scan_sql() -> str:
    """scan() of documents in DuckDB's SQL."""
    quoted = ", ".join("('{}', '{}')".format(i.replace("'", "''"), t.replace("'", "''")) for i, t in KNOWN)
    return f"""
WITH known AS (SELECT sha256({canonical_sql('body')}) AS digest, min(license_id) AS license_id FROM (VALUES {quoted}) v(license_id, body) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (SELECT r, license_id FROM (SELECT r, sha256({canonical_sql('line')}) AS digest FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d)) JOIN known USING (digest)),
found AS (SELECT r, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids FROM lines GROUP BY 1)
SELECT doc_id, sha256({canonical_sql('text')}) AS text_digest, license_id, coalesce(n, 0) AS n_license_lines, coalesce(ids, '') AS line_licenses
FROM d LEFT JOIN found USING (r) LEFT JOIN known ON digest = sha256({canonical_sql('text')})"""
