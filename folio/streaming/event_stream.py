"""Event tables as streams: an addition to the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def state_counts(events: DataFrame, time: str = "ts", by: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and kind; state older than the watermark is dropped."""
    timed = events.withWatermark(time, late).groupBy(F.window(time, window), by)
    return timed.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), by, "n", "total")
