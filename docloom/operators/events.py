"""Event records and the outbox rows that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id, iso_instant
from docloom.functions.json_text import spaced_json
from docloom.operators.tables import conform
from docloom.operators.uniqueness import first_per_key


def _record(contract: str, event_type: str, as_of, **extra: Column) -> list[Column]:
    """Contract columns from rows with parent ids; a child keeps the chain's correlation id and
    names its parent as the cause. Ids follow from the parent, so replays repeat them."""
    values = {
        "event_id": derived_id("tenant_id", "parent_event_id", F.lit(event_type)),
        "event_type": F.lit(event_type),
        "occurred_at": iso_instant(F.lit(as_of).cast("timestamp")),
        "correlation_id": F.col("correlation_id"),
        "causation_id": F.col("parent_event_id"),
        "tenant_id": F.col("tenant_id"),
        "document_id": F.col("document_id"),
        "schema_version": F.lit(schemas.SCHEMA_VERSION),
        **extra,
    }
    return [values.get(name, F.col(name)).alias(name)
            for name in schemas.field_names(schemas.CONTRACTS[contract])]


def submitted_events(df: DataFrame, as_of) -> DataFrame:
    """From (tenant_id, document_id, document_version_id, payload_uri[, correlation_id])."""
    own_id = derived_id("tenant_id", "document_version_id", F.lit("DocumentSubmitted"))
    correlation = F.coalesce("correlation_id", own_id) if "correlation_id" in df.columns else own_id
    return df.withColumn("parent_event_id", F.lit(None).cast("string")).select(*_record(
        "document-submitted", "DocumentSubmitted", as_of,
        event_id=own_id, correlation_id=correlation))


def fetched_events(df: DataFrame, as_of) -> DataFrame:
    return df.select(*_record(
        "document-fetched", "DocumentFetched", as_of, inspection_status=F.lit("valid")))


def fetch_rejected_events(df: DataFrame, as_of) -> DataFrame:
    return df.select(*_record(
        "document-fetch-rejected", "DocumentFetchRejected", as_of,
        inspection_status=F.lit("invalid")))


def extracted_events(df: DataFrame, as_of) -> DataFrame:
    return df.select(*_record("content-extracted", "ContentExtracted", as_of))


def extraction_rejected_events(df: DataFrame, as_of) -> DataFrame:
    return df.select(*_record(
        "content-extraction-rejected", "ContentExtractionRejected", as_of))


def outbox_rows(
    events: DataFrame, contract: str, aggregate_type: str, aggregate_id: str, topic: str, as_of
) -> DataFrame:
    """Pending outbox rows for contract-shaped events."""
    fields = schemas.field_names(schemas.CONTRACTS[contract])
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    headers = spaced_json([
        ("event_type", F.col("event_type"), None),
        ("causation_id", F.col("causation_id"), F.col("causation_id").isNotNull()),
    ])
    now = F.lit(as_of).cast("timestamp")
    return conform(events.select(
        derived_id(F.col("tenant_id"), F.col("event_id"), F.lit("outbox")).alias("id"),
        "tenant_id", "event_id",
        F.lit(aggregate_type).alias("aggregate_type"),
        F.col(aggregate_id).alias("aggregate_id"),
        "event_type",
        F.lit(topic).alias("kafka_topic"),
        F.lit(schemas.EVENT_NAMESPACE).alias("event_contract_namespace"),
        F.lit(contract).alias("event_schema_name"),
        payload.alias("payload"),
        headers.alias("headers"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempt_count"),
        now.alias("available_at"),
        now.alias("created_at"),
    ), schemas.TABLES["ingestion_outbox"])


def route(events: DataFrame, expected_type: str) -> tuple[DataFrame, DataFrame]:
    """Events of the expected type, and all others (a null type is another)."""
    expected = F.col("event_type").eqNullSafe(F.lit(expected_type))
    return events.filter(expected), events.filter(~expected)


def fresh_events(
    events: DataFrame, ledger: DataFrame, consumer: str, order: str = "event_offset"
) -> DataFrame:
    """Events this consumer has not handled: first arrival per (tenant, event), ledger excluded."""
    keys = ["tenant_id", "event_id"]
    done = ledger.filter(F.col("consumer_name") == consumer).select(*keys)
    # Copies go first: what is left has unique keys, already partitioned for the anti join.
    return first_per_key(events, keys, order).join(done, keys, "left_anti")


def ledger_rows(events: DataFrame, consumer: str, as_of) -> DataFrame:
    return conform(events.select(
        "tenant_id", "event_id",
        F.lit(consumer).alias("consumer_name"),
        F.lit(as_of).cast("timestamp").alias("processed_at"),
        F.lit("{}").alias("result"),
    ), schemas.TABLES["processed_events"])


def topic_for(
    accepted: Column, attempts: Column, transient: Column, stage: str, next_topic: str,
    max_attempts: int,
) -> Column:
    """Next topic when accepted; a transient failure goes to the stage's retry topic until its
    attempts are used up, everything else to its dead-letter topic."""
    return F.when(accepted, F.lit(next_topic)) \
        .when(transient & (attempts < max_attempts), F.lit(schemas.retry_topic(stage))) \
        .otherwise(F.lit(schemas.dead_letter_topic(stage)))
