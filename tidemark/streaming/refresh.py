"""Incremental refresh of derived tables from a stream of changed rows, and the windowed counts streams are asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.tables import refresh
from tidemark.sources.files import swap_in


def refresh_stream(changes: DataFrame, target: str, keys: Sequence[str], derive: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """For each micro-batch, recomputes the derived rows of the touched keys and swaps them into the table at ``target``
    (delete-then-insert). A batch that is run again gives the same table."""

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(*keys).distinct()
        fresh = derive(batch)
        try:
            old = spark.read.parquet(target)
        except Exception:  # noqa: BLE001  (the first batch)
            old = fresh.limit(0)
        swap_in(refresh(old, fresh, keys, touched), target)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per tumbling window and key; rows later than the watermark are dropped by a stream and counted by a batch."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def read_changes(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
