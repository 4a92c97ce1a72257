"""Event-time windows over a stream of events: an addition, the batch queries have no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def weekly(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Sums of each event type and week; rows later than ``late`` are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "7 days"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
