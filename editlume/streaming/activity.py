"""Activity over arriving revision files: weekly counts with late data, sessions as a stateful operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def revision_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100, delay: str = "7 days") -> DataFrame:
    """Revisions of parquet files as they arrive, with event_time (zone-less times taken as UTC) and its watermark."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return raw.withColumn("event_time", F.col("rev_timestamp").cast("timestamp")).withWatermark("event_time", delay)


def once_per_id(stream: DataFrame) -> DataFrame:
    """Rows repeated under one rev_id within the watermark count once."""
    return stream.dropDuplicatesWithinWatermark(["rev_id"])


def weekly_edits(stream: DataFrame) -> DataFrame:
    """Edits and approximate editors per week starting on Monday; weeks close when the watermark has passed."""
    week = F.window("event_time", "7 days", startTime="4 days")  # the epoch was a Thursday
    return (
        stream.groupBy(week).agg(F.count("*").alias("edits"), F.approx_count_distinct("rev_user").alias("editors"))
        .select(F.col("window.start").cast("date").alias("week"), "edits", "editors")
    )


def live_sessions(stream: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Sessions of registered users, closed when the watermark has passed the gap after their last edit."""
    w = F.session_window("event_time", f"{gap_seconds} seconds")
    return (
        stream.where("rev_user > 0").groupBy("rev_user", w).agg(F.count("*").alias("edits"), F.max("event_time").alias("last_edit"))
        .select("rev_user", F.col("session_window.start").alias("started_at"), "last_edit", "edits")
    )


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has arrived and stop; the checkpoint remembers what has been done."""
    return df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
