"""Structured Streaming forms of the work queue, the evidence counts and the yearly metrics.

Each takes a streaming or a static DataFrame: on a finished stream they give what the batch
form gives. State is bounded by the watermark or by the number of pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

event_schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(event_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def work_queue(papers: DataFrame) -> DataFrame:
    """Papers to process: pending, with an abstract."""
    return papers.filter("processing_status = 'pending' AND abstract IS NOT NULL AND abstract <> ''")


def evidence_counts(edges: DataFrame) -> DataFrame:
    """Running outcome counts by pair, for update mode; the state has one row a pair."""
    return edges.groupBy("source", "target").agg(F.count_if(F.col("outcome") == "improves").alias("pos"), F.count_if(F.col("outcome") == "worsens").alias("neg"), F.count("*").alias("n"))


def outcome_windows(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and means by event type in tumbling windows; events over ``late`` behind are dropped with their window's state."""
    stream = events.withWatermark("ts", late) if events.isStreaming else events
    return stream.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").alias("start"), "event_type", "n", "mean")


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; the checkpoint makes the next run go on from here."""
    return stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
