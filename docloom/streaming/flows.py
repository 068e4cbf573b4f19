"""Stream forms of de-duplication, retry routing and metric windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.events import topic_for


def dedup_within(events: DataFrame, keys: Sequence[str], ts: str, horizon: str) -> DataFrame:
    """First copy per key within ``horizon`` of event time. State is bounded by the watermark; the
    ledger join of the stages is the unbounded, exact form."""
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(list(keys))


def routed(
    results: DataFrame, *, accepted: Column, attempts: Column, transient: Column, stage: str,
    next_topic: str, max_attempts: int,
) -> DataFrame:
    """Results with their next topic; a stateless projection, so any stream can carry it."""
    return results.withColumn("topic", topic_for(
        accepted, attempts, transient, stage, next_topic, max_attempts))


def outcome_windows(
    stream: DataFrame, labels: Sequence[str], ts: str, width: str = "15 seconds",
    lateness: str = "1 minute",
) -> DataFrame:
    """Counts per label set and tumbling window; a window closes ``lateness`` after its end."""
    return stream.withWatermark(ts, lateness) \
        .groupBy(F.window(ts, width).alias("window"), *labels) \
        .agg(F.count(F.lit(1)).alias("messages")) \
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), *labels, "messages")


def to_table(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
             ) -> StreamingQuery:
    """Append a stream to parquet, exactly once through the file sink's log."""
    writer = stream.writeStream.format("parquet").outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()
