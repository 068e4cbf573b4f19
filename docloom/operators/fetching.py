"""Fetch stage: inspect stored objects, settle each submitted event, derive all writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id, first_code, sha256
from docloom.functions.json_text import spaced_json
from docloom.functions.keys import object_key
from docloom.operators.events import (
    fetch_rejected_events, fetched_events, fresh_events, ledger_rows, outbox_rows,
)
from docloom.operators.tables import conform, last_per_key, live, upsert

# Code to message. Fixed values.
MESSAGES = {
    "unknown_source_object": "Submitted object is not a current document version.",
    "unexpected_event_type": "Fetcher accepts only DocumentSubmitted events.",
    "invalid_pdf_signature": "Object does not start with a PDF signature.",
    "document_too_large": "PDF exceeds the configured document byte limit.",
    "encrypted_pdf_unsupported": "Encrypted PDFs are not supported by this pipeline.",
    "corrupt_pdf": "PDF could not be read by the PDF inspector.",
    "source_checksum_mismatch": "Stored object differs from submitted version.",
    "declared_mime_type_mismatch":
        "The submitted MIME type is not permitted by the PDF-first fetcher.",
}

Inspector = Callable[[bytes], tuple[str | None, int | None]]


class StageResult(NamedTuple):
    versions: DataFrame
    documents: DataFrame
    failures: DataFrame | None
    outbox: DataFrame
    ledger: DataFrame
    quarantine: DataFrame
    version_changes: DataFrame
    document_changes: DataFrame


def inspect(
    objects: DataFrame,
    *,
    signature: str = schemas.PDF_SIGNATURE,
    detected_mime: str = "application/pdf",
    max_bytes: int = schemas.FETCH_LIMIT_BYTES,
    factory: Callable[[], Inspector] | None = None,
) -> DataFrame:
    """One narrow row per object; the content is not carried on.

    ``objects``: object_uri, content, and byte_size where the source knows it: an object whose
    content was left unread for its size is refused by that. The digest is taken only of objects that pass signature and
    size. ``factory`` makes a format inspector, once per partition; it returns an error code and
    a page count for content that passed.
    """
    content = F.col("content").cast("binary")
    size = F.octet_length("content").cast("bigint")
    if "byte_size" in objects.columns:
        size = F.coalesce(size, F.col("byte_size"))
    signed = F.substring(content, 1, len(signature)) == F.lit(signature.encode())
    checked = objects.select(
        "object_uri",
        size.alias("byte_size"),
        first_code((~signed, "invalid_pdf_signature"), (size > max_bytes, "document_too_large"))
        .alias("inspection_code"),
        content.alias("content"),
    )
    digest = F.when(F.col("inspection_code").isNull(), sha256("content"))
    narrow = checked.withColumn("content_sha256", digest)
    if factory is None:
        narrow = narrow.withColumn("page_count", F.lit(None).cast("bigint"))
    else:
        narrow = _run_inspector(narrow, factory)
    return narrow.select(
        "object_uri", "byte_size", "inspection_code", "content_sha256", "page_count",
        F.lit(detected_mime).alias("detected_mime_type"),
    )


def _run_inspector(checked: DataFrame, factory: Callable[[], Inspector]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inspector = factory()
        for batch in batches:
            codes, pages = [], []
            for code, content in zip(batch["inspection_code"], batch["content"]):
                found, count = code, None
                if code is None:
                    try:
                        found, count = inspector(bytes(content))
                    except (ImportError, MemoryError):
                        raise
                    except Exception:
                        found = "corrupt_pdf"
                codes.append(found)
                pages.append(count)
            yield pd.DataFrame({
                "object_uri": batch["object_uri"],
                "byte_size": batch["byte_size"],
                "inspection_code": codes,
                "content_sha256": batch["content_sha256"],
                "page_count": pd.array(pages, dtype="Int64"),
            })

    # Content that is refused already has no way to make.
    passed = F.when(F.col("inspection_code").isNull(), F.col("content"))
    return checked.withColumn("content", passed).mapInPandas(
        run, "object_uri string, byte_size bigint, inspection_code string, "
             "content_sha256 string, page_count bigint")


def empty_objects(objects: DataFrame, versions: DataFrame) -> DataFrame | None:
    """Zero-length objects, which a binary file scan leaves out: versions of zero bytes whose object
    was not listed. Versions that carry no size or no object name give none."""
    if not {"byte_size", "source_object_uri"} <= set(versions.columns):
        return None
    return versions.filter("byte_size = 0") \
        .select(F.col("source_object_uri").alias("object_uri")).distinct() \
        .join(objects.select("object_uri"), "object_uri", "left_anti") \
        .withColumn("content", F.lit("").cast(objects.schema["content"].dataType)) \
        .withColumn("byte_size", F.lit(0).cast("bigint"))


def with_empty_objects(objects: DataFrame, versions: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``objects`` and the empty ones; of both only those ``wanted`` (object_uri) names, if given.

    The wanted URIs meet the objects where these lie: in a table bucketed by URI no content moves.
    """
    def named(df: DataFrame) -> DataFrame:
        return df if wanted is None else df.join(wanted, "object_uri", "left_semi")

    empty = empty_objects(objects, versions)
    if empty is None:
        return named(objects)
    carried = [c for c in ("object_uri", "content", "byte_size") if c in objects.columns]
    return named(objects.select(*carried)).unionByName(named(empty.select(*carried)))


def one_per_object(rows: DataFrame) -> DataFrame:
    """One of the narrow ``rows`` of each object_uri, the least, however often it was landed."""
    rest = [c for c in rows.columns if c != "object_uri"]
    least = rows.groupBy("object_uri").agg(F.min(F.struct(*rest)).alias("least"))
    return least.select("object_uri", "least.*")


def _versions_by_object(versions: DataFrame) -> DataFrame:
    """Live versions per (tenant, document, source object), with their number."""
    keys = ["tenant_id", "document_id", "source_object_uri"]
    return live(versions).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("version_matches"),
        F.min("id").alias("document_version_id"),
        F.min("mime_type").alias("mime_type"),
        F.min("content_sha256").alias("version_sha256"),
    ).withColumnRenamed("source_object_uri", "payload_uri")


def fetch_verdicts(
    events: DataFrame,
    inspected: DataFrame,
    versions: DataFrame,
    ledger: DataFrame,
    *,
    bucket: str,
    permitted_mime: tuple[str, ...] = schemas.PERMITTED_MIME,
) -> DataFrame:
    """One row per fresh event with ``code`` (null when valid) and ``quarantine`` (our own code
    for events the stage cannot settle: bad URI, missing object, ambiguous version)."""
    fresh = fresh_events(events, ledger, schemas.FETCHER) \
        .withColumnRenamed("event_id", "parent_event_id") \
        .withColumn("is_expected",
                    F.col("event_type").eqNullSafe(F.lit("DocumentSubmitted")))
    found = one_per_object(inspected).withColumnRenamed("object_uri", "payload_uri") \
        .withColumn("has_object", F.lit(True))
    joined = fresh.join(found, "payload_uri", "left").join(
        _versions_by_object(versions), ["tenant_id", "document_id", "payload_uri"], "left")
    code = first_code(
        (F.col("document_version_id").isNull(), "unknown_source_object"),
        (~F.col("is_expected"), "unexpected_event_type"),
    )
    code = F.coalesce(
        code,
        F.col("inspection_code"),
        first_code(
            (F.col("content_sha256") != F.col("version_sha256"), "source_checksum_mismatch"),
            (~F.col("mime_type").isin(*permitted_mime), "declared_mime_type_mismatch"),
        ),
    )
    quarantine = first_code(
        (F.col("is_expected") & object_key("payload_uri", bucket).isNull(), "invalid_source_uri"),
        (F.col("is_expected") & F.col("has_object").isNull(), "missing_object"),
        (F.col("version_matches") > 1, "ambiguous_version"),
    )
    return joined.select(
        "tenant_id", "parent_event_id", "event_offset", "event_type", "correlation_id",
        "document_id", "payload_uri", "document_version_id", "mime_type", "detected_mime_type",
        "content_sha256", "byte_size", "page_count",
        quarantine.alias("quarantine"),
        F.when(quarantine.isNull(), code).alias("code"),
    )


def _limits(max_bytes: int):
    """The two limit members of an oversize record. Reading stops at one byte over the limit."""
    oversize = F.col("code") == "document_too_large"
    return [
        ("max_document_bytes", F.lit(max_bytes), oversize),
        ("observed_bytes_at_rejection", F.lit(max_bytes + 1), oversize),
    ]


def with_metadata(verdicts: DataFrame, max_bytes: int) -> DataFrame:
    """Add ``inspection_metadata`` (stored on the version) and ``event_metadata`` (in the event)."""
    messages = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    valid = [
        ("declared_mime_type", F.col("mime_type"), None),
        ("detected_mime_type", F.col("detected_mime_type"), None),
        ("format", F.lit("pdf"), None),
        ("is_encrypted", F.lit(False), None),
        ("max_document_bytes", F.lit(max_bytes), None),
        ("preliminary_page_count", F.col("page_count"), F.col("page_count").isNotNull()),
    ]
    failed = [
        ("validation_error", F.col("code"), None),
        ("message", F.try_element_at(messages, F.col("code")), None),
        *_limits(max_bytes),
    ]
    rejected = [*_limits(max_bytes), ("validation_error", F.col("code"), None)]
    good = F.col("code").isNull()
    return verdicts \
        .withColumn("event_metadata",
                    F.when(good, spaced_json(valid)).otherwise(spaced_json(rejected))) \
        .withColumn("inspection_metadata",
                    F.when(good, spaced_json(valid)).otherwise(spaced_json(failed)))


def version_changes(settled: DataFrame) -> DataFrame:
    """Last inspection outcome per version."""
    known = settled.filter("document_version_id IS NOT NULL").select(
        "tenant_id", F.col("document_version_id").alias("id"), "event_offset",
        F.when(F.col("code").isNull(), "valid").otherwise("invalid").alias("inspection_status"),
        F.when(F.col("code").isNull(), F.col("detected_mime_type")).alias("detected_mime_type"),
        "inspection_metadata",
    )
    return last_per_key(known, ["tenant_id", "id"], "event_offset",
                        ["inspection_status", "detected_mime_type", "inspection_metadata"])


def document_changes(settled: DataFrame) -> DataFrame:
    known = settled.filter("document_version_id IS NOT NULL").select(
        "tenant_id", F.col("document_id").alias("id"), "event_offset",
        F.when(F.col("code").isNull(), "fetched").otherwise("failed").alias("status"),
    )
    return last_per_key(known, ["tenant_id", "id"], "event_offset", ["status"])


def failure_rows(settled: DataFrame, as_of) -> DataFrame:
    """One row per refused event whose version is known."""
    now = F.lit(as_of).cast("timestamp")
    return conform(
        settled.filter("code IS NOT NULL AND document_version_id IS NOT NULL").select(
            derived_id("tenant_id", "parent_event_id", F.lit("failure")).alias("id"),
            "tenant_id", "document_version_id",
            F.col("parent_event_id").alias("event_id"),
            F.lit(schemas.FETCHER).alias("stage"),
            F.lit("validation").alias("error_class"),
            F.col("code").alias("error_code"),
            F.col("inspection_metadata").alias("error_detail"),
            now.alias("first_seen_at"), now.alias("last_seen_at"),
            F.lit(1).alias("occurrence_count"),
        ), schemas.TABLES["ingestion_failures"])


def fetch_outbox(settled: DataFrame, as_of) -> DataFrame:
    """Fetched events for the next stage and rejected ones for the dead-letter topic."""
    ready = settled.withColumn("inspection_metadata", F.col("event_metadata"))
    good = outbox_rows(
        fetched_events(ready.filter("code IS NULL"), as_of),
        "document-fetched", "document_version", "document_version_id",
        schemas.DOCUMENT_FETCHED, as_of)
    bad = outbox_rows(
        fetch_rejected_events(ready.filter("code IS NOT NULL"), as_of),
        "document-fetch-rejected", "document", "document_id",
        schemas.dead_letter_topic(schemas.FETCHER), as_of)
    return good.unionByName(bad)


def quarantined(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter("quarantine IS NOT NULL").select(
        "tenant_id", F.col("parent_event_id").alias("event_id"), "document_id", "payload_uri",
        F.col("quarantine").alias("reason"))


def fetch_outputs(
    verdicts: DataFrame, versions: DataFrame, documents: DataFrame, *, as_of, max_bytes: int
) -> StageResult:
    """All writes of the stage. ``verdicts`` is read once per output: hand in a stored table."""
    settled = with_metadata(verdicts.filter("quarantine IS NULL"), max_bytes)
    changed_versions, changed_documents = version_changes(settled), document_changes(settled)
    return StageResult(
        versions=upsert(versions, changed_versions, ["tenant_id", "id"], as_of),
        documents=upsert(documents, changed_documents, ["tenant_id", "id"], as_of),
        version_changes=changed_versions,
        document_changes=changed_documents,
        failures=failure_rows(settled, as_of),
        outbox=fetch_outbox(settled, as_of),
        ledger=ledger_rows(
            settled.withColumnRenamed("parent_event_id", "event_id"), schemas.FETCHER, as_of),
        quarantine=quarantined(verdicts),
    )


def fetch_stage(
    events: DataFrame,
    objects: DataFrame,
    versions: DataFrame,
    documents: DataFrame,
    ledger: DataFrame,
    *,
    bucket: str,
    as_of,
    signature: str = schemas.PDF_SIGNATURE,
    max_bytes: int = schemas.FETCH_LIMIT_BYTES,
    permitted_mime: tuple[str, ...] = schemas.PERMITTED_MIME,
    factory: Callable[[], Inspector] | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StageResult:
    """``store`` materializes the verdicts once (a checkpoint or a written table)."""
    inspected = inspect(with_empty_objects(objects, versions), signature=signature,
                        max_bytes=max_bytes, factory=factory)
    verdicts = store(fetch_verdicts(
        events, inspected, versions, ledger, bucket=bucket, permitted_mime=permitted_mime))
    return fetch_outputs(verdicts, versions, documents, as_of=as_of, max_bytes=max_bytes)
