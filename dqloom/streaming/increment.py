"""Periodic deltas as a stream: each start processes what is new in a folder and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def run_available(spark: SparkSession, source: str, schema, process: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, created: str | None = None, late: str | None = None) -> StreamingQuery:
    """Process the files that arrived since the last start, batch by batch, and write each batch's result under target/batch=<id>.

    A batch that is run again after a failure overwrites its own folder, so results are written once; offsets are committed
    after that. With created and late, rows later than the watermark allows can be dropped by stateful steps of process.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    if created and late:
        stream = stream.withWatermark(created, late)

    def each(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_outliers_by_hour(stream: DataFrame, created: str, out: str, late: str = "1 hour") -> DataFrame:
    """Outliers per hour of creation on a stream of resolved rows; an hour is final once the watermark has passed it."""
    return stream.withWatermark(created, late).where(F.col(out) == "OUTLIER").groupBy(F.window(created, "1 hour").alias("hour")).agg(F.count("*").alias("n"))
