"""Counters, roll-ups and work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_counts(df: DataFrame, labels: Sequence[str], name: str = "messages") -> DataFrame:
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias(name))


def failure_rollup(failures: DataFrame) -> DataFrame:
    """First and last sighting and total count per (tenant, version, stage, code)."""
    return failures.groupBy("tenant_id", "document_version_id", "stage", "error_code").agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("occurrence_count").alias("occurrence_count"),
    )


def status_funnel(documents: DataFrame) -> DataFrame:
    """Live documents per tenant and status."""
    return outcome_counts(documents.filter("deleted_at IS NULL"), ["tenant_id", "status"],
                          "documents")


def status_matrix(documents: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """The funnel with one column per status; the fixed list spares a pass for distinct values."""
    return documents.filter("deleted_at IS NULL").groupBy("tenant_id") \
        .pivot("status", list(statuses)).count().na.fill(0)


def open_failures(failures: DataFrame) -> DataFrame:
    return failures.filter("resolved_at IS NULL") \
        .orderBy("tenant_id", "stage", F.desc("last_seen_at"), "id")


def audit_timeline(audit_log: DataFrame) -> DataFrame:
    return audit_log.orderBy("tenant_id", F.desc("occurred_at"), "id")


def quality_by_tenant(results: DataFrame) -> DataFrame:
    """Extraction metrics per tenant and the share of results that need review."""
    review = F.col("extraction_status") == "needs_review"
    return results.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("source_bytes").alias("source_bytes"),
        F.sum("text_characters").alias("text_characters"),
        F.sum("table_count").alias("table_count"),
        F.sum("figure_count").alias("figure_count"),
        F.count_if(review).alias("needs_review"),
        F.avg(review.cast("double")).alias("review_share"),
    )
