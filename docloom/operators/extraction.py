"""Extract stage: convert sources, keep evidence and quality metrics, settle fetched events."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import first_code, sha256, stripped
from docloom.functions.json_text import canonical_json, spaced_json, strip_binary
from docloom.functions.keys import artifact_key, object_key, object_uri
from docloom.functions.markup import figure_evidence, list_size
from docloom.operators.events import (
    extracted_events, extraction_rejected_events, fresh_events, ledger_rows, outbox_rows,
)
from docloom.operators.fetching import (
    StageResult, one_per_object, quarantined, with_empty_objects,
)
from docloom.operators.tables import last_per_key, live, upsert
from docloom.session import bounded_batches

NOT_PERFORMED = "not_performed"  # fixed value of visual_interpretation
FAILURE_CODE = "conversion_failed"
PIECE_BYTES = 4 << 20  # content a converter's task holds at a time, beside its texts; one document at least

# Bytes to (document tree as JSON text, text, error code).
Converter = Callable[[bytes], tuple[str | None, str | None, str | None]]


class Extraction(NamedTuple):
    stage: StageResult
    artifacts: DataFrame


FACTS = ("object_uri", "source_bytes", "source_code", "source_sha256")


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with up to ``PIECE_BYTES`` in a column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
        yield batch.slice(low, high - low)
        low = high


def convert(
    objects: DataFrame, factory: Callable[[], Converter],
    max_bytes: int = schemas.EXTRACT_LIMIT_BYTES,
    failure_code: str = FAILURE_CODE,
) -> DataFrame:
    """Facts and converted form of every (object_uri, content), in one pass over the content.

    Size, size code and digest are columns; only content inside the limits goes on to the
    converter, through Arrow batches that it takes and gives back in pieces of ``PIECE_BYTES``. The
    factory runs once per partition, so models load once there. A converter that raises gives ``failure_code`` for that document only; a missing module
    or memory ends the job, as a badly built worker must not condemn documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        converter = factory()
        for piece in (p for batch in batches for p in _pieces(batch, "content")):
            made = []
            for content in piece.column("content"):
                if not content.is_valid:
                    made.append((None, None, None))
                    continue
                try:
                    made.append(converter(content.as_py()))
                except (ImportError, MemoryError):  # the worker's fault, not the document's
                    raise
                except Exception:
                    made.append((None, None, failure_code))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(name) for name in FACTS), *(pa.array(x, pa.string(), from_pandas=True) for x in zip(*made))],
                names=[*FACTS, "document", "markdown", "conversion_error"])

    content = F.col("content").cast("binary")
    size = F.octet_length(content).cast("bigint")
    if "byte_size" in objects.columns:  # content above a limit may have been left unread
        size = F.coalesce(size, F.col("byte_size"))
    bounded = objects.select(
        "object_uri", size.alias("source_bytes"),
        first_code((size > max_bytes, "source_too_large"), (size == 0, "empty_source"))
        .alias("source_code"),
        sha256(content).alias("source_sha256"), content.alias("content"),
    ).withColumn("content", F.when(F.col("source_code").isNull(), F.col("content")))
    bounded_batches(objects.sparkSession, 2 * PIECE_BYTES)
    return bounded.mapInArrow(
        run, "object_uri string, source_bytes bigint, source_code string, source_sha256 string, "
             "document string, markdown string, conversion_error string")


def normalize(converted: DataFrame) -> DataFrame:
    """Evidence and counts of each converted document.

    Adds ``tree`` (variant without binary members), ``figures`` and the count columns.
    """
    return converted \
        .withColumn("tree", F.try_parse_json(strip_binary("document"))) \
        .withColumn("figures", figure_evidence(F.col("tree"))) \
        .withColumn("text_characters",
                    F.coalesce(F.length(stripped("markdown")), F.lit(0)).cast("bigint")) \
        .withColumn("table_count", list_size(F.col("tree"), "tables")) \
        .withColumn("figure_count", F.size("figures").cast("bigint")) \
        .withColumn("conversion_error",
                    F.when(F.col("conversion_error").isNotNull(), F.col("conversion_error"))
                    .when(~F.coalesce(F.schema_of_variant("tree").startswith("OBJECT"),
                                      F.lit(False)),
                          F.lit("invalid_converter_output")))


def quality_json(**extra) -> list:
    return [
        ("empty_text", F.col("text_characters") == 0, None),
        ("figure_count", F.col("figure_count"), None),
        ("source_bytes", F.col("source_bytes"), None),
        ("table_count", F.col("table_count"), None),
        ("text_characters", F.col("text_characters"), None),
        ("visual_interpretation", F.lit(NOT_PERFORMED), None),
    ]


def quality_struct():
    return F.struct(*[value.alias(name) for name, value, _ in quality_json()])


def extraction_status():
    return F.when(F.col("text_characters") == 0, F.lit("needs_review")) \
        .otherwise(F.lit("succeeded"))


def normalized_json(fmt: str):
    return canonical_json(
        schema_version=F.lit(schemas.SCHEMA_VERSION),
        format=F.lit(fmt),
        markdown=F.col("markdown"),
        document=F.col("tree"),
        figures=F.col("figures"),
        visual_interpretation=F.lit(NOT_PERFORMED),
    )


def manifest_json(extractor: str, extractor_version: str):
    return canonical_json(
        extractor=F.lit(extractor),
        extractor_version=F.lit(extractor_version),
        quality=quality_struct(),
        source_content_sha256=F.col("content_sha256"),
        extraction_status=extraction_status(),
    )


def extract_verdicts(
    events: DataFrame,
    normalized: DataFrame,
    versions: DataFrame,
    ledger: DataFrame,
    *,
    bucket: str,
    artifact_bucket: str,
    mime: str = "application/pdf",
) -> DataFrame:
    """One row per fresh event with ``code`` (null when extracted) and ``quarantine``.

    All inputs of the joins are narrow: of ``normalized`` only facts and counts are read.
    """
    fresh = fresh_events(events, ledger, schemas.EXTRACTOR) \
        .withColumnRenamed("event_id", "parent_event_id") \
        .withColumnRenamed("document_version_id", "event_version_id")
    gate = first_code(
        (~F.col("event_type").eqNullSafe(F.lit("DocumentFetched")), "unexpected_event_type"),
        (~(F.col("inspection_status").eqNullSafe(F.lit("valid"))
           & F.col("detected_mime_type").eqNullSafe(F.lit(mime))), "unsupported_source"),
    )
    # An object listed or landed twice is still one object.
    sources = one_per_object(normalized.select(
        "object_uri", *FACTS[1:], "conversion_error", "text_characters", "table_count",
        "figure_count")).withColumnRenamed("object_uri", "payload_uri")
    current = live(versions).select(
        "tenant_id", "document_id", F.col("id").alias("event_version_id"), "content_sha256",
        F.lit(True).alias("is_current"))
    joined = fresh.withColumn("gate", gate) \
        .join(sources, "payload_uri", "left") \
        .join(current, ["tenant_id", "document_id", "event_version_id", "content_sha256"], "left")
    code = F.coalesce(
        F.col("gate"),
        F.col("source_code"),
        F.col("conversion_error"),
        first_code(
            (~F.col("source_sha256").eqNullSafe(F.col("content_sha256")),
             "source_checksum_mismatch"),
            (F.col("is_current").isNull(), "unknown_document_version"),
        ),
    )
    quarantine = first_code(
        (F.col("gate").isNull() & object_key("payload_uri", bucket).isNull(),
         "invalid_source_uri"),
        (F.col("gate").isNull() & F.col("source_bytes").isNull(), "missing_object"),
    )

    def uri(name: str):
        return object_uri(
            artifact_bucket, artifact_key("tenant_id", "event_version_id", "content_sha256", name))

    return joined.select(
        "tenant_id", "parent_event_id", "event_offset", "correlation_id", "document_id",
        F.col("event_version_id").alias("document_version_id"), "payload_uri", "content_sha256",
        "source_bytes", "text_characters", "table_count", "figure_count",
        extraction_status().alias("extraction_status"),
        uri("normalized.json").alias("normalized_artifact_uri"),
        uri("manifest.json").alias("manifest_uri"),
        quarantine.alias("quarantine"),
        F.when(quarantine.isNull(), code).alias("code"),
    )


def artifacts(
    verdicts: DataFrame, normalized: DataFrame, *, fmt: str, extractor: str,
    extractor_version: str,
) -> DataFrame:
    """(tenant_id, object_uri, body): two JSON artifacts per converted event.

    They are written before the version is looked up, so an unknown version leaves them behind.
    """
    kept = verdicts.filter(
        "quarantine IS NULL AND (code IS NULL OR code = 'unknown_document_version')"
    ).select("tenant_id", "payload_uri", "content_sha256", "source_bytes",
             "normalized_artifact_uri", "manifest_uri") \
        .dropDuplicates(["normalized_artifact_uri"])
    trees = normalized.select(F.col("object_uri").alias("payload_uri"), "markdown", "tree",
                              "figures", "text_characters", "table_count", "figure_count")
    bodies = kept.join(trees, "payload_uri")
    pair = F.array(  # bodies are keyed by content: equal ones fold when read
        F.struct(F.col("normalized_artifact_uri").alias("object_uri"),
                 normalized_json(fmt).alias("body")),
        F.struct(F.col("manifest_uri").alias("object_uri"),
                 manifest_json(extractor, extractor_version).alias("body")),
    )
    return bodies.select("tenant_id", F.inline(pair))


def extract_outputs(
    verdicts: DataFrame, versions: DataFrame, documents: DataFrame, *, as_of, extractor: str,
    extractor_version: str,
) -> StageResult:
    settled = verdicts.filter("quarantine IS NULL")
    good = F.col("code").isNull()
    config = spaced_json([("extractor", F.lit(extractor), None),
                          ("extractor_version", F.lit(extractor_version), None)])
    version_rows = settled.select(
        "tenant_id", F.col("document_version_id").alias("id"), "event_offset",
        F.when(good, F.col("normalized_artifact_uri")).alias("normalized_object_uri"),
        F.when(good, F.col("manifest_uri")).alias("extraction_manifest_uri"),
        F.when(good, F.col("extraction_status")).otherwise("failed").alias("extraction_status"),
        F.when(good, config).alias("extraction_config"),
        F.when(good, spaced_json(quality_json()))
        .otherwise(spaced_json([("error_code", F.col("code"), None)]))
        .alias("extraction_metadata"),
    )
    # A document counts as extracted only when text was found; one that needs review is failed,
    # though its ContentExtracted event goes out all the same.
    document_rows = settled.select(
        "tenant_id", F.col("document_id").alias("id"), "event_offset",
        F.when(good & (F.col("extraction_status") == "succeeded"), "extracted")
        .otherwise("failed").alias("status"),
    )
    done = extracted_events(
        settled.filter(good)
        .withColumn("extractor_name", F.lit(extractor))
        .withColumn("extractor_version", F.lit(extractor_version))
        .withColumn("quality_summary", spaced_json(quality_json())), as_of)
    refused = extraction_rejected_events(
        settled.filter(~good).withColumnRenamed("code", "error_code"), as_of)
    outbox = outbox_rows(
        done, "content-extracted", "document_version", "document_version_id",
        schemas.CONTENT_EXTRACTED, as_of,
    ).unionByName(outbox_rows(
        refused, "content-extraction-rejected", "document_version", "document_version_id",
        schemas.dead_letter_topic(schemas.EXTRACTOR), as_of))
    version_columns = ["normalized_object_uri", "extraction_manifest_uri", "extraction_status",
                       "extraction_config", "extraction_metadata"]
    changed_versions = last_per_key(
        version_rows, ["tenant_id", "id"], "event_offset", version_columns)
    changed_documents = last_per_key(
        document_rows, ["tenant_id", "id"], "event_offset", ["status"])
    return StageResult(
        versions=upsert(versions, changed_versions, ["tenant_id", "id"], as_of),
        documents=upsert(documents, changed_documents, ["tenant_id", "id"], as_of),
        version_changes=changed_versions,
        document_changes=changed_documents,
        failures=None,
        outbox=outbox,
        ledger=ledger_rows(
            settled.withColumnRenamed("parent_event_id", "event_id"), schemas.EXTRACTOR, as_of),
        quarantine=quarantined(verdicts),
    )


def extract_stage(
    events: DataFrame,
    objects: DataFrame,
    versions: DataFrame,
    documents: DataFrame,
    ledger: DataFrame,
    *,
    factory: Callable[[], Converter],
    bucket: str,
    artifact_bucket: str,
    as_of,
    extractor: str,
    extractor_version: str,
    fmt: str = "pdf",
    mime: str = "application/pdf",
    max_bytes: int = schemas.EXTRACT_LIMIT_BYTES,
    failure_code: str = FAILURE_CODE,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
    store_bodies: Callable[[DataFrame], DataFrame] | None = None,
) -> Extraction:
    """Only objects that an event names are read, each once.

    ``store`` materializes the verdicts and ``store_bodies`` the converted documents, both of which
    several outputs read. With objects in a table bucketed by URI, and converted documents stored as
    one (``sources.objects.bucketed``), content and bodies stay where they were read: the events'
    URIs and the verdicts come to them.
    """
    wanted = events.select(F.col("payload_uri").alias("object_uri")).distinct()
    named = with_empty_objects(objects, versions, wanted)
    normalized = (store_bodies or store)(normalize(convert(named, factory, max_bytes, failure_code)).drop("document"))
    verdicts = store(extract_verdicts(
        events, normalized, versions, ledger, bucket=bucket, artifact_bucket=artifact_bucket,
        mime=mime))
    return Extraction(
        extract_outputs(verdicts, versions, documents, as_of=as_of, extractor=extractor,
                        extractor_version=extractor_version),
        artifacts(verdicts, normalized, fmt=fmt, extractor=extractor,
                  extractor_version=extractor_version),
    )
