"""Incremental ingest of local rows: an extension, the batch operators don't need it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed(events: DataFrame, time: str, kind: str, id_: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts by window and kind of events that are distinct by id within the allowed lateness; state is bounded by it."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.dropDuplicatesWithinWatermark([id_]).groupBy(F.window(time, size), kind).agg(F.count("*").alias("n"))


def run_once(df: DataFrame, checkpoint: str, path: str) -> None:
    """Takes in what has landed, then stops; a later call goes on from there."""
    df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
