"""Incremental versions of the scan and of turn counts, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kelpforge.sources.jsonl import _judge


def judged_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New JSONL files of a folder as (file, line, record as JSON, reason)."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    judged = _judge(raw.select(F.input_file_name().alias("file"), F.col("value").alias("line")))
    return judged.withColumn("record", F.to_json("record"))


def first_seen(stream: DataFrame, key: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are forgotten once the watermark has passed."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, event_time: str, by: str, width: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Counts by window and value, final once the watermark has passed."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), by).agg(F.count(F.lit(1)).alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there now and stops; calling it again takes only what came since."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
