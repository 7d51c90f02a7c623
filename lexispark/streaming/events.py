"""Structured Streaming over the event table: windows, sessions, deduplication, incremental postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators.search import postings


def event_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """File stream of event parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and type, late events admitted up to the watermark."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    g = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", F.round("total", 6).alias("total"))


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return s.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def distinct_events(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def index_batches(stream: DataFrame, key: str, columns: list[str], folder: str, checkpoint: str):
    """Append the postings of every micro-batch, one folder per batch, so a repeated batch overwrites its own rows."""

    def write(batch: DataFrame, epoch: int) -> None:
        postings(batch, key, columns).write.mode("overwrite").parquet(f"{folder}/batch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
