"""Submission: defaults, size and name rules, conflicts, metadata fan-out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id, or_default, present, sha256
from docloom.functions.keys import object_uri, source_object_key
from docloom.operators.events import outbox_rows, submitted_events
from docloom.operators.tables import conform
from docloom.operators.uniqueness import admit_first
from docloom.session import cut_lineage

CREATED, CONFLICT, TOO_LARGE, NO_FILENAME = 201, 409, 413, 422
SOURCE_SYSTEM = "api"
UNIQUE = (("tenant_id", "source_external_id"), ("tenant_id", "content_sha256"))


class SubmitResult(NamedTuple):
    outcomes: DataFrame
    documents: DataFrame
    versions: DataFrame
    outbox: DataFrame


def prepare(submissions: DataFrame, bucket: str) -> DataFrame:
    """Narrow one row per submission: digests and defaults in, content out.

    ``submissions``: seq (unique bigint), tenant_id, document_id, filename, title,
    source_external_id, mime_type, classification, declared_bytes, content. The content is read,
    hashed and dropped in the scan's own stage; nothing after this carries it.
    """
    key = source_object_key("tenant_id", "document_id", F.coalesce("filename", F.lit("")))
    return submissions.select(
        "seq", "tenant_id", "document_id", "filename",
        derived_id("tenant_id", "document_id", F.lit("version"), F.lit(1))
        .alias("document_version_id"),
        or_default("source_external_id", F.col("document_id")).alias("source_external_id"),
        or_default("title", F.col("filename")).alias("title"),
        F.coalesce("classification", F.lit("internal")).alias("classification"),
        or_default("mime_type", "application/octet-stream").alias("mime_type"),
        "declared_bytes",
        F.octet_length("content").cast("bigint").alias("byte_size"),
        sha256("content").alias("content_sha256"),
        key.alias("object_key"),
        object_uri(bucket, key).alias("source_object_uri"),
    )


def screen(prepared: DataFrame, max_bytes: int) -> DataFrame:
    """Add ``refusal``: the status of the first rule a submission breaks on its own, or null."""
    return prepared.withColumn(
        "refusal",
        F.when(F.col("declared_bytes") > max_bytes, F.lit(TOO_LARGE))
        .when(present("filename").isNull(), F.lit(NO_FILENAME))
        .when(F.col("byte_size") > max_bytes, F.lit(TOO_LARGE)),
    )


def accepted_rows(
    screened: DataFrame, tenants: DataFrame, documents: DataFrame, versions: DataFrame
) -> DataFrame:
    """``seq`` of the submissions that insert without breaking a key or reference."""
    known = tenants.select(F.col("id").alias("tenant_id"))
    held_ids = documents.filter(F.col("source_system") == SOURCE_SYSTEM) \
        .select("tenant_id", "source_external_id")
    held_content = versions.select("tenant_id", "content_sha256")
    candidates = screened.filter("refusal IS NULL") \
        .select("seq", "tenant_id", "source_external_id", "content_sha256") \
        .join(known, "tenant_id", "left_semi") \
        .join(held_ids, ["tenant_id", "source_external_id"], "left_anti") \
        .join(held_content, ["tenant_id", "content_sha256"], "left_anti") \
        .select("seq", "tenant_id", "source_external_id", "content_sha256")
    return admit_first(cut_lineage(candidates), UNIQUE, "seq")


def decide(
    screened: DataFrame, tenants: DataFrame, documents: DataFrame, versions: DataFrame
) -> DataFrame:
    """Prepared rows with ``status_code``."""
    accepted = accepted_rows(screened, tenants, documents, versions) \
        .withColumn("is_accepted", F.lit(True))
    return screened.join(accepted, "seq", "left").withColumn(
        "status_code",
        F.coalesce("refusal", F.when(F.col("is_accepted"), F.lit(CREATED)), F.lit(CONFLICT)),
    ).drop("refusal", "is_accepted")


def document_rows(accepted: DataFrame, as_of) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    return conform(accepted.select(
        F.col("document_id").alias("id"), "tenant_id",
        F.lit(SOURCE_SYSTEM).alias("source_system"), "source_external_id", "title",
        "classification", F.lit("submitted").alias("status"),
        F.col("document_version_id").alias("current_version_id"),
        now.alias("created_at"), now.alias("updated_at"),
    ), schemas.TABLES["documents"])


def version_rows(accepted: DataFrame, as_of) -> DataFrame:
    """Version 1 of each accepted submission."""
    now, empty = F.lit(as_of).cast("timestamp"), F.lit("{}")
    return conform(accepted.select(
        F.col("document_version_id").alias("id"), "tenant_id", "document_id",
        F.lit(1).alias("version_number"), "content_sha256", "source_object_uri", "mime_type",
        "byte_size", empty.alias("extraction_config"), empty.alias("extraction_metadata"),
        empty.alias("model_versions"), F.lit("pending").alias("inspection_status"),
        empty.alias("inspection_metadata"), F.lit("pending").alias("extraction_status"),
        now.alias("created_at"), now.alias("updated_at"),
    ), schemas.TABLES["document_versions"])


def submitted_outbox(accepted: DataFrame, as_of) -> DataFrame:
    events = submitted_events(
        accepted.withColumnRenamed("source_object_uri", "payload_uri"), as_of)
    return outbox_rows(
        events, "document-submitted", "document", "document_id", schemas.DOCUMENT_SUBMITTED, as_of)


def fan_out(accepted: DataFrame, as_of) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows for documents, versions and the outbox."""
    return (document_rows(accepted, as_of), version_rows(accepted, as_of),
            submitted_outbox(accepted, as_of))


def submit(
    submissions: DataFrame,
    tenants: DataFrame,
    documents: DataFrame,
    versions: DataFrame,
    *,
    bucket: str,
    as_of,
    max_bytes: int = schemas.UPLOAD_LIMIT_BYTES,
) -> SubmitResult:
    # The narrow rows are stored once: content is read and hashed in a single pass.
    screened = cut_lineage(screen(prepare(submissions, bucket), max_bytes))
    outcomes = decide(screened, tenants, documents, versions)
    return SubmitResult(outcomes, *fan_out(outcomes.filter(F.col("status_code") == CREATED), as_of))
