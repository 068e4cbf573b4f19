"""Event chains and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.ranking import previous


def causal_links(events: DataFrame) -> DataFrame:
    """Each event with its cause inside the same chain; events without a known cause drop out."""
    parents = events.select(
        "correlation_id",
        F.col("event_id").alias("causation_id"),
        F.col("event_type").alias("parent_type"),
    )
    return events.join(parents, ["correlation_id", "causation_id"])


def stage_latency(events: DataFrame) -> DataFrame:
    """Seconds since the previous event of the chain (null for its first)."""
    ordered = previous(events, ["correlation_id"], ["occurred_at", "event_id"], "occurred_at", "previous_at")
    return ordered.withColumn(
        "latency_us",
        F.unix_micros(F.col("occurred_at").cast("timestamp"))
        - F.unix_micros(F.col("previous_at").cast("timestamp")))


def provenance(
    points: DataFrame, chunks: DataFrame, versions: DataFrame, documents: DataFrame
) -> DataFrame:
    """Point to chunk to version to document and source URI."""
    chunk = chunks.select("tenant_id", "point_id", F.col("id").alias("chunk_id"),
                          "document_version_id", "chunk_index", "section_path", "content_sha256")
    version = versions.select("tenant_id", F.col("id").alias("document_version_id"),
                              "document_id", "version_number", "source_object_uri",
                              "normalized_object_uri")
    document = documents.select("tenant_id", F.col("id").alias("document_id"),
                                "source_system", "source_external_id", "title")
    return points.select("tenant_id", "point_id") \
        .join(chunk, ["tenant_id", "point_id"]) \
        .join(version, ["tenant_id", "document_version_id"]) \
        .join(document, ["tenant_id", "document_id"])
