"""What an endpoint remembers between runs, as three Parquet tables that are swapped in whole.

memory has validated values (resolvers' verdicts and corrections by hand), matches what was settled against a
name base with a certain fingerprint, mappings every value ever seen with its last result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.memory import upsert
from . import sinks

SCHEMAS = {
    "memory": "api_id string, field string, k string, v string",
    "matches": "api_id string, field string, fingerprint string, k string, v string, method string",
    "mappings": "api_id string, field string, raw string, value string",
}
KEYS = {"memory": ["api_id", "field", "k"], "matches": ["api_id", "field", "k"], "mappings": ["api_id", "field", "raw"]}


class Remembered:
    """The tables of one folder, which may be in any store that Spark writes to. A table that isn't there yet is empty."""

    def __init__(self, spark: SparkSession, folder: str, api_id: str):
        self.spark, self.folder, self.api_id = spark, folder.rstrip("/"), api_id

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name)) if sinks.exists(self.spark, self.path(name)) else self.spark.createDataFrame([], SCHEMAS[name])

    def of_field(self, name: str, field: str) -> DataFrame:
        return self.table(name).where((F.col("api_id") == self.api_id) & (F.col("field") == field)).drop("api_id", "field")

    def memory(self, field: str) -> DataFrame:
        """Validated values as k, v."""
        return self.of_field("memory", field)

    def matches(self, field: str, fingerprint: str) -> DataFrame:
        """Earlier matches as k, v, method, if the base is still the same."""
        return self.of_field("matches", field).where(F.col("fingerprint") == fingerprint).drop("fingerprint")

    def mapping(self, field: str) -> DataFrame:
        """Every value seen so far as raw, value."""
        return self.of_field("mappings", field)

    def save(self, name: str, new: dict[str, DataFrame]) -> None:
        """The rows of each field in place of earlier ones with their keys. Nothing new, nothing written."""
        rows = None
        for field, df in new.items():
            named = df.select(F.lit(self.api_id).alias("api_id"), F.lit(field).alias("field"), *df.columns)
            rows = named if rows is None else rows.unionByName(named)
        if rows is not None:
            columns = self.spark.createDataFrame([], SCHEMAS[name]).columns
            sinks.write_table(upsert(self.table(name), rows.select(*columns).dropDuplicates(KEYS[name]), KEYS[name]), self.path(name))
