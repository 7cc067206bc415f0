"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A normalised text is cut into chunks where its own characters say so, so equal passages give
equal chunks. A chunk's identifier is its digest, verified against every chunk text that has
it; a text's recipe is the ordered list of identifiers. Recipes, a few hundredths of the text's size, are
compared and joined; the text itself is moved once, for the verification, repeated chunks once per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, written

LONGEST = 8192  # characters; a chunk without an earlier boundary ends here
BLANKS = r"[\x20\x09-\x0D]+"


def _every(step: int, offset: int) -> str:
    """A class of the Latin-1 letters and signs whose code leaves offset modulo step."""
    return "[" + "".join(f"\\x{c:02X}" for c in range(0x21, 0x100) if c % step == offset) + "]"


#: A boundary is a blank after three characters of certain residues: about one blank in a hundred.
BOUNDARY = rf"(?<={_every(5, 1)}{_every(5, 2)}{_every(4, 1)}|{_every(6, 1)}{_every(5, 4)}{_every(5, 0)}) "
CHUNK = rf"(?s).{{1,{LONGEST - 1}}}?(?:{BOUNDARY}|\z)|.{{1,{LONGEST}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def chunks(text: Column) -> Column:
    """The chunks of a normalised text; joined they are the text again. An empty text has none."""
    return F.filter(F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)), lambda c: c != "")


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: key, keep_id, group_size, kept, text_sha256, n_chunks, n_rows (times that it is there).

    Texts are equal when their recipes are. Of equal texts the smallest key stays. Null text counts as
    empty, and all empty texts are one group. A row repeated with the same key and text is one
    document: it is returned once, and group_size counts all its rows. Rows of one key with different texts
    are separate documents. Null keys never win over others. An empty table gives an empty result; other columns
    don't matter. Should two chunks ever share an identifier, the job stops rather than merge different texts.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), normalised(F.col(f"`{text}`")).alias("text"))
    cut = source.select("key", F.sha2("text", 256).alias("sha"), chunks(F.col("text")).alias("parts"))
    pieces = source.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    distinct = pieces.groupBy(F.xxhash64("chunk").alias("h"), "chunk").agg(F.count("*").alias("n"))
    clashes = distinct.groupBy(identifier(F.col("chunk")).alias("id")).agg(F.count("*").alias("texts")).where("texts > 1").agg(F.count("*").alias("n"))
    verified = clashes.select(F.when(F.col("n") > 0, F.raise_error(F.lit("two different chunks share an identifier"))).otherwise(F.lit(True)).cast("boolean"))
    recipes = cut.select("key", "sha", F.transform("parts", identifier).alias("recipe"))
    rows = written(recipes.groupBy("key", "sha", "recipe").agg(F.count("*").alias("rows")), "recipes")
    # Written, so the join deals both sides anew and a hot recipe's rows can be split.
    groups = written(rows.groupBy("recipe").agg(F.min("key").alias("keep_id"), F.sum("rows").alias("group_size")), "groups")
    return (
        rows.join(groups, "recipe")
        .where(verified.scalar())
        .select(
            F.col("key").alias(key), "keep_id", "group_size",
            F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"), F.size("recipe").cast("long").alias("n_chunks"), F.col("rows").alias("n_rows"),
        )
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, whose text is the first of its group; rows repeated with the same key and text once."""
    judged = exact_groups(docs, text, key).select(F.col(key).alias("k"), F.col("text_sha256").alias("m"), F.col("kept").alias("stays"), F.col("n_rows").alias("n"))
    return keep_rows(docs, key, F.sha2(normalised(F.col(f"`{text}`")), 256), judged)
