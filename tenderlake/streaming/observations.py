"""Observations by day, as a batch or as a stream with a watermark; both use the same plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def daily(events: DataFrame, late: str | None = None) -> DataFrame:
    """(window_start, event_type, n, total); with `late`, a stream's days close that long after their end."""
    seen = events.withWatermark("ts", late) if late else events
    out = seen.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    return out.select(F.col("w.start").cast("timestamp").alias("window_start"), "event_type", "n", "total")


def latest_stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A directory of Parquet files as a stream, each event once even if it arrives again within a day."""
    seen = spark.readStream.schema(like.schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return seen.withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["event_id"])
