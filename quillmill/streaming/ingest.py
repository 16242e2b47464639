"""Streams: documents as they arrive, and event-time windows over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """Documents (JSON lines) of a folder, as files arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def first_arrivals(stream: DataFrame, key: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; what state is held is bounded by the delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def weekly_counts(stream: DataFrame, event_time: str, group: list[str], value: str, delay: str = "1 day") -> DataFrame:
    """group, week_start, n, total: tumbling windows of seven days; rows later than the delay are left out."""
    windows = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, "7 days"), *group)
    counted = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
    return counted.select(*group, F.col("window.start").alias("week_start"), "n", "total")


def session_counts(stream: DataFrame, event_time: str, group: list[str], gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """group, start, end, n: sessions that end after a gap."""
    sessions = stream.withWatermark(event_time, delay).groupBy(F.session_window(event_time, gap), *group).agg(F.count(F.lit(1)).alias("n"))
    return sessions.select(*group, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Start a query that takes what there is and stops; run again, it goes on from its checkpoint."""
    return stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
