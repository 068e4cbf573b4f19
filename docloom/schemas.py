"""Declared schemas: tables, event contracts, allowed values and integrity rules."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# Names that appear on the wire or in stored rows.

EVENT_NAMESPACE = "rag.ingestion.v1"
SCHEMA_VERSION = "1.0.0"

DOCUMENT_SUBMITTED = f"{EVENT_NAMESPACE}.document.submitted"
DOCUMENT_FETCHED = f"{EVENT_NAMESPACE}.document.fetched"
CONTENT_EXTRACTED = f"{EVENT_NAMESPACE}.content.extracted"
CHUNKS_CREATED = f"{EVENT_NAMESPACE}.chunks.created"
EMBEDDINGS_GENERATED = f"{EVENT_NAMESPACE}.embeddings.generated"
DOCUMENT_INDEXED = f"{EVENT_NAMESPACE}.document.indexed"
EVENT_TOPICS = (
    DOCUMENT_SUBMITTED,
    DOCUMENT_FETCHED,
    CONTENT_EXTRACTED,
    CHUNKS_CREATED,
    EMBEDDINGS_GENERATED,
    DOCUMENT_INDEXED,
)

FETCHER = "document-fetcher"
EXTRACTOR = "content-extractor"
STAGES = (FETCHER, EXTRACTOR, "chunker", "embedder", "indexer")

DAY_MS = 24 * 60 * 60 * 1000
EVENT_RETENTION_MS = 7 * DAY_MS
RETRY_RETENTION_MS = DAY_MS
DEAD_LETTER_RETENTION_MS = 30 * DAY_MS

TENANT_STATUS = ("active", "suspended", "deleted")
DOCUMENT_STATUS = (
    "submitted", "fetching", "fetched", "extracting", "extracted", "chunking",
    "embedding", "indexing", "ready", "failed", "deleted",
)
OUTBOX_STATUS = ("pending", "publishing", "published", "failed")
PRINCIPAL_TYPE = ("user", "group", "role")
PERMISSION = ("read", "manage")
ACTOR_TYPE = ("user", "service", "system")
INSPECTION_STATUS = ("pending", "valid", "invalid", "unsupported")
EXTRACTION_STATUS = ("pending", "succeeded", "partial", "needs_review", "failed")

SLUG_PATTERN = "^[a-z0-9][a-z0-9-]{1,62}$"
SHA256_PATTERN = "^[0-9a-f]{64}$"

UPLOAD_LIMIT_BYTES = 52_428_800
FETCH_LIMIT_BYTES = 52_428_800
EXTRACT_LIMIT_BYTES = 268_435_456
CLAIM_BATCH_MAX = 1_000
ERROR_TEXT_MAX = 4_000
PERMITTED_MIME = ("application/pdf", "application/octet-stream")
PDF_SIGNATURE = "%PDF-"
BINARY_KEYS = ("image", "image_data", "data", "binary", "base64", "pixels")
# End of fixed values.
# ---------------------------------------------------------------------------------------------


def retry_topic(stage: str) -> str:
    return f"{EVENT_NAMESPACE}.{stage}.retry"


def dead_letter_topic(stage: str) -> str:
    return f"{EVENT_NAMESPACE}.{stage}.dlq"


TABLES = {
    "tenants": (
        "id string, slug string, display_name string, status string, data_residency string, "
        "created_at timestamp, updated_at timestamp"
    ),
    "documents": (
        "id string, tenant_id string, source_system string, source_external_id string, "
        "title string, classification string, status string, current_version_id string, "
        "discovered_at timestamp, created_at timestamp, updated_at timestamp, deleted_at timestamp"
    ),
    "document_versions": (
        "id string, tenant_id string, document_id string, version_number int, "
        "content_sha256 string, source_object_uri string, normalized_object_uri string, "
        "mime_type string, byte_size bigint, language_code string, extraction_config string, "
        "extraction_metadata string, model_versions string, detected_mime_type string, "
        "inspection_status string, inspection_metadata string, extraction_status string, "
        "extraction_manifest_uri string, created_at timestamp, updated_at timestamp, "
        "deleted_at timestamp"
    ),
    "document_acl": (
        "id string, tenant_id string, document_id string, principal_type string, "
        "principal_id string, permission string, created_at timestamp"
    ),
    "chunks": (
        "id string, tenant_id string, document_version_id string, chunk_index int, "
        "point_id string, content_sha256 string, page_from int, page_to int, "
        "section_path array<string>, token_count int, character_count int, is_active boolean, "
        "embedding_model string, embedding_model_version string, chunking_strategy string, "
        "created_at timestamp, deleted_at timestamp"
    ),
    "ingestion_outbox": (
        "id string, tenant_id string, event_id string, aggregate_type string, "
        "aggregate_id string, event_type string, kafka_topic string, "
        "event_contract_namespace string, event_schema_name string, payload string, "
        "headers string, status string, attempt_count int, available_at timestamp, "
        "locked_at timestamp, locked_by string, published_at timestamp, last_error string, "
        "created_at timestamp"
    ),
    "processed_events": (
        "tenant_id string, event_id string, consumer_name string, processed_at timestamp, "
        "result string"
    ),
    "ingestion_failures": (
        "id string, tenant_id string, document_version_id string, event_id string, stage string, "
        "error_class string, error_code string, error_detail string, first_seen_at timestamp, "
        "last_seen_at timestamp, occurrence_count int, resolved_at timestamp"
    ),
    "audit_log": (
        "id bigint, tenant_id string, actor_type string, actor_id string, action string, "
        "entity_type string, entity_id string, correlation_id string, metadata string, "
        "occurred_at timestamp"
    ),
}

# What the stages store beside the tables: events no stage could settle, records of no contract.
STORED = {
    **TABLES,
    "quarantine": "tenant_id string, event_id string, document_id string, payload_uri string, reason string",
    "bad_records": "bad_record string",
}

_ENVELOPE_HEAD = (
    "event_id string, event_type string, occurred_at string, correlation_id string, "
    "causation_id string, tenant_id string, document_id string"
)

# One record layout per event, in contract field order.
CONTRACTS = {
    "document-submitted": f"{_ENVELOPE_HEAD}, payload_uri string, schema_version string",
    "document-fetched": (
        f"{_ENVELOPE_HEAD}, document_version_id string, payload_uri string, "
        "detected_mime_type string, content_sha256 string, byte_size bigint, "
        "inspection_status string, inspection_metadata string, schema_version string"
    ),
    "document-fetch-rejected": (
        f"{_ENVELOPE_HEAD}, payload_uri string, inspection_status string, "
        "inspection_metadata string, schema_version string"
    ),
    "content-extracted": (
        f"{_ENVELOPE_HEAD}, document_version_id string, normalized_artifact_uri string, "
        "manifest_uri string, content_sha256 string, extractor_name string, "
        "extractor_version string, extraction_status string, quality_summary string, "
        "schema_version string"
    ),
    "content-extraction-rejected": (
        f"{_ENVELOPE_HEAD}, document_version_id string, error_code string, schema_version string"
    ),
}

# Only the first event of a chain may lack a cause.
NULLABLE_FIELDS = {"document-submitted": ("causation_id",)}


def field_names(ddl: str) -> list[str]:
    """Column names of a flat DDL string (no commas inside types)."""
    return [part.split()[0] for part in ddl.split(", ")]


# Integrity rules --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    table: str
    rule: str
    valid: str  # SQL predicate; a row breaks the rule when it is false, as a null one passes


@dataclass(frozen=True)
class UniqueKey:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


CHECKS = (
    Check("tenants", "slug_shape", f"slug RLIKE '{SLUG_PATTERN}'"),
    Check("tenants", "status_value", _one_of("status", TENANT_STATUS)),
    Check("documents", "status_value", _one_of("status", DOCUMENT_STATUS)),
    Check("document_versions", "version_number_positive", "version_number > 0"),
    Check("document_versions", "sha_shape", f"content_sha256 RLIKE '{SHA256_PATTERN}'"),
    Check("document_versions", "byte_size_not_negative", "byte_size >= 0"),
    Check("document_versions", "inspection_status_value",
          _one_of("inspection_status", INSPECTION_STATUS)),
    Check("document_versions", "extraction_status_value",
          _one_of("extraction_status", EXTRACTION_STATUS)),
    Check("document_acl", "principal_type_value", _one_of("principal_type", PRINCIPAL_TYPE)),
    Check("document_acl", "permission_value", _one_of("permission", PERMISSION)),
    Check("chunks", "chunk_index_not_negative", "chunk_index >= 0"),
    Check("chunks", "sha_shape", f"content_sha256 RLIKE '{SHA256_PATTERN}'"),
    Check("chunks", "page_from_positive", "page_from > 0"),
    Check("chunks", "page_range", "page_to >= page_from"),
    Check("chunks", "token_count_positive", "token_count > 0"),
    Check("chunks", "character_count_positive", "character_count > 0"),
    Check("ingestion_outbox", "status_value", _one_of("status", OUTBOX_STATUS)),
    Check("ingestion_outbox", "attempt_count_not_negative", "attempt_count >= 0"),
    Check("ingestion_failures", "occurrence_count_positive", "occurrence_count > 0"),
    Check("audit_log", "actor_type_value", _one_of("actor_type", ACTOR_TYPE)),
)

NOT_NULL = {
    "tenants": ("id", "slug", "display_name", "status", "created_at", "updated_at"),
    "documents": ("id", "tenant_id", "source_system", "source_external_id", "classification",
                  "status", "created_at", "updated_at"),
    "document_versions": ("id", "tenant_id", "document_id", "version_number", "content_sha256",
                          "source_object_uri", "mime_type", "byte_size", "extraction_config",
                          "extraction_metadata", "model_versions", "inspection_status",
                          "inspection_metadata", "extraction_status", "created_at", "updated_at"),
    "document_acl": ("id", "tenant_id", "document_id", "principal_type", "principal_id",
                     "permission", "created_at"),
    "chunks": ("id", "tenant_id", "document_version_id", "chunk_index", "point_id",
               "content_sha256", "section_path", "token_count", "character_count", "is_active",
               "embedding_model", "embedding_model_version", "chunking_strategy", "created_at"),
    "ingestion_outbox": ("id", "tenant_id", "event_id", "aggregate_type", "aggregate_id",
                         "event_type", "kafka_topic", "event_contract_namespace",
                         "event_schema_name", "payload", "headers", "status", "attempt_count",
                         "available_at", "created_at"),
    "processed_events": ("tenant_id", "event_id", "consumer_name", "processed_at", "result"),
    "ingestion_failures": ("id", "tenant_id", "stage", "error_class", "error_detail",
                           "first_seen_at", "last_seen_at", "occurrence_count"),
    "audit_log": ("id", "tenant_id", "actor_type", "actor_id", "action", "entity_type",
                  "metadata", "occurred_at"),
}

UNIQUE_KEYS = (
    UniqueKey("tenants", ("id",)),
    UniqueKey("tenants", ("slug",)),
    UniqueKey("documents", ("id",)),
    UniqueKey("documents", ("tenant_id", "source_system", "source_external_id")),
    UniqueKey("documents", ("tenant_id", "id")),
    UniqueKey("document_versions", ("id",)),
    UniqueKey("document_versions", ("tenant_id", "document_id", "version_number")),
    UniqueKey("document_versions", ("tenant_id", "content_sha256")),
    UniqueKey("document_versions", ("tenant_id", "id")),
    UniqueKey("document_acl", ("id",)),
    UniqueKey("document_acl",
              ("tenant_id", "document_id", "principal_type", "principal_id", "permission")),
    UniqueKey("chunks", ("id",)),
    UniqueKey("chunks", ("tenant_id", "document_version_id", "chunk_index")),
    UniqueKey("chunks", ("point_id",)),
    UniqueKey("ingestion_outbox", ("id",)),
    UniqueKey("ingestion_outbox", ("tenant_id", "event_id")),
    UniqueKey("processed_events", ("tenant_id", "event_id", "consumer_name")),
    UniqueKey("ingestion_failures", ("id",)),
    UniqueKey("audit_log", ("id",)),
)

FOREIGN_KEYS = (
    ForeignKey("documents", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("documents", ("tenant_id", "current_version_id"),
               "document_versions", ("tenant_id", "id")),
    ForeignKey("document_versions", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("document_versions", ("tenant_id", "document_id"),
               "documents", ("tenant_id", "id")),
    ForeignKey("document_acl", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("document_acl", ("tenant_id", "document_id"), "documents", ("tenant_id", "id")),
    ForeignKey("chunks", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("chunks", ("tenant_id", "document_version_id"),
               "document_versions", ("tenant_id", "id")),
    ForeignKey("ingestion_outbox", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("processed_events", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("ingestion_failures", ("tenant_id",), "tenants", ("id",)),
    ForeignKey("ingestion_failures", ("tenant_id", "document_version_id"),
               "document_versions", ("tenant_id", "id")),
    ForeignKey("audit_log", ("tenant_id",), "tenants", ("id",)),
)
