"""Structured Streaming around the same plans. The windows have no counterpart in what they stand beside: they are Spark's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, path: str, schema, per_trigger: int = 1) -> DataFrame:
    """Parquet files as they arrive, with the event time as a timestamp (watermarks need one with a zone)."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Counts by tumbling or sliding windows and kind; rows later than the watermark are left out."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "2 hours") -> DataFrame:
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(s.alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("s.start").alias("start"), "n")


def run_available(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Everything that is there now, batch by batch, then an end: a poll that can be repeated. Progress is kept in the checkpoint."""
    query = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(sink).start()
    query.awaitTermination()
    return query
