"""Submission and fetch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import sha256
from docloom.functions.keys import guessed_mime, object_key, uri_part
from docloom.functions.markup import detected_type, sensitive_counts, SENSITIVE
from docloom.operators import fetching as fetch
from docloom.operators import submission as sub
from docloom.operators.events import fresh_events, topic_for
from docloom.operators.metrics import failure_rollup, outcome_counts
from docloom.operators.tables import upsert
from docloom.plans import views as v
from docloom.plans.registry import query, uuid_sql
from docloom.session import cut_lineage, scratch
from docloom.sources.objects import (
    land_objects, missing_objects, orphan_objects, read_landed, read_objects,
)

ISO = "2024-01-16T00:00:00+00:00"


@query("submit_defaults_keys", """
    SELECT document_id, source_external_id, title, classification, mime_type, object_key,
      byte_size, content_sha256, CAST(COALESCE(refusal, 0) AS INTEGER) AS refusal
    FROM v_prepared""")
def submit_defaults_keys(spark, sf):
    return v.prepared(spark, sf).select(
        "document_id", "source_external_id", "title", "classification", "mime_type",
        "object_key", "byte_size", "content_sha256",
        F.coalesce("refusal", F.lit(0)).alias("refusal"))


@query("submit_conflicts", """
    WITH RECURSIVE candidates AS (
      SELECT p.*, CAST(document_id AS BIGINT) IN (SELECT doc_id FROM labels) AS is_prior
      FROM v_prepared p
      WHERE refusal IS NULL AND tenant_id IN (SELECT id FROM v_tenants)),
    ordered AS (
      SELECT tenant_id, seq, source_external_id AS ext, content_sha256 AS sha,
        row_number() OVER (PARTITION BY tenant_id ORDER BY is_prior DESC, seq) AS step
      FROM candidates),
    admitted AS (
      SELECT tenant_id, CAST(0 AS BIGINT) AS step, CAST(NULL AS BIGINT) AS seq, FALSE AS ok,
        CAST([] AS VARCHAR[]) AS exts, CAST([] AS VARCHAR[]) AS shas
      FROM (SELECT DISTINCT tenant_id FROM ordered)
      UNION ALL
      SELECT tenant_id, step, seq, ok,
        CASE WHEN ok THEN list_append(exts, ext) ELSE exts END,
        CASE WHEN ok THEN list_append(shas, sha) ELSE shas END
      FROM (SELECT o.*, a.exts, a.shas,
              NOT list_contains(a.exts, o.ext) AND NOT list_contains(a.shas, o.sha) AS ok
            FROM admitted a JOIN ordered o ON o.tenant_id = a.tenant_id AND o.step = a.step + 1))
    SELECT p.document_id,
      CAST(COALESCE(p.refusal, CASE WHEN a.ok THEN 201 END, 409) AS INTEGER) AS status_code
    FROM v_prepared p LEFT JOIN admitted a ON a.seq = p.seq
    WHERE CAST(p.document_id AS BIGINT) NOT IN (SELECT doc_id FROM labels)""")
def submit_conflicts(spark, sf):
    """Labelled documents are submitted first; the rest then meet them and one another."""
    screened, tenants = cut_lineage(v.prepared(spark, sf)), v.tenants(spark, sf)
    labelled = v.table(spark, sf, "labels").select(F.col("doc_id").alias("seq"))
    first = screened.join(labelled, "seq", "left_semi")
    second = screened.join(labelled, "seq", "left_anti")
    no_documents = spark.createDataFrame([], schemas.TABLES["documents"])
    no_versions = spark.createDataFrame([], schemas.TABLES["document_versions"])
    held = sub.decide(first, tenants, no_documents, no_versions) \
        .filter(F.col("status_code") == sub.CREATED)
    return sub.decide(
        second, tenants, sub.document_rows(held, v.AS_OF), sub.version_rows(held, v.AS_OF),
    ).select("document_id", "status_code")


@query("submit_fan_out", f"""
    SELECT e.document_id, p.document_version_id AS current_version_id, e.event_id,
      '{schemas.DOCUMENT_SUBMITTED}' AS kafka_topic, p.source_external_id, p.byte_size,
      '{{"event_id":"' || e.event_id || '","event_type":"DocumentSubmitted","occurred_at":"{ISO}"'
      || ',"correlation_id":"' || e.event_id || '","causation_id":null,"tenant_id":"'
      || e.tenant_id || '","document_id":"' || e.document_id || '","payload_uri":"'
      || p.source_object_uri || '","schema_version":"1.0.0"}}' AS payload
    FROM (SELECT *, {uuid_sql('tenant_id', 'document_version_id', "'DocumentSubmitted'")} AS event_id
          FROM v_prepared WHERE refusal IS NULL) e JOIN v_prepared p USING (seq)""")
def submit_fan_out(spark, sf):
    """Metadata rows of every submission that passes its own rules, joined back together."""
    rows = v.prepared(spark, sf).filter("refusal IS NULL")
    documents, versions, outbox = sub.fan_out(rows, v.AS_OF)
    version = versions.select("tenant_id", F.col("id").alias("current_version_id"), "byte_size")
    event = outbox.select("tenant_id", F.col("aggregate_id").alias("document_id"), "event_id",
                          "kafka_topic", "payload")
    return documents.withColumnRenamed("id", "document_id") \
        .join(version, ["tenant_id", "current_version_id"]) \
        .join(event, ["tenant_id", "document_id"]) \
        .select("document_id", "current_version_id", "event_id", "kafka_topic",
                "source_external_id", "byte_size", "payload")


@query("uri_validate", f"""
    WITH uris AS (SELECT url AS uri FROM pages
                  UNION ALL SELECT payload_uri FROM v_submitted)
    SELECT uri, lower(regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
      regexp_extract(uri, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
      CASE WHEN uri LIKE 's3://{v.BUCKET}/%'
           THEN regexp_extract(uri, '^s3://[^/?#]*/*([^?#]*)', 1) ELSE '' END AS object_key
    FROM uris""")
def uri_validate(spark, sf):
    uris = v.table(spark, sf, "pages").select(F.col("url").alias("uri")).unionAll(
        v.submitted(spark, sf).select("payload_uri"))
    return uris.select(
        "uri", F.lower(uri_part("uri", 1)).alias("scheme"), uri_part("uri", 2).alias("host"),
        F.coalesce(object_key("uri", v.BUCKET), F.lit("")).alias("object_key"))


@query("mime_guess", """
    SELECT document_id, CASE WHEN filename = '' THEN 'application/octet-stream'
      ELSE 'application/pdf' END AS guessed FROM v_submissions""")
def mime_guess(spark, sf):
    return v.submissions(spark, sf).select("document_id", guessed_mime("filename").alias("guessed"))


@query("html_inspect", """
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS byte_size,
      CASE WHEN NOT starts_with(html, '<!DOCTYPE html') THEN 'invalid_pdf_signature'
           WHEN strlen(html) > 4000 THEN 'document_too_large' ELSE 'valid' END AS outcome,
      CASE WHEN starts_with(html, '<!DOCTYPE html') AND strlen(html) <= 4000
           THEN sha256(html) ELSE '' END AS content_sha256
    FROM pages""")
def html_inspect(spark, sf):
    """The signature and size rules with an HTML signature."""
    pages = v.table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("object_uri"), F.col("html").alias("content"))
    return fetch.inspect(pages, signature="<!DOCTYPE html", max_bytes=4000).select(
        F.col("object_uri").cast("bigint").alias("page_id"), "byte_size",
        F.coalesce("inspection_code", F.lit("valid")).alias("outcome"),
        F.coalesce("content_sha256", F.lit("")).alias("content_sha256"))


def line_inspector():
    """Pages as form feeds or lines; content with a pipe raises, content with a hash sign is locked."""
    def inspect(content: bytes):
        if b"|" in content:
            raise ValueError("not readable")
        return ("encrypted_pdf", None) if b"#" in content else (None, content.count(b"\n"))

    return inspect


@query("object_inspection", f"""
    SELECT object_uri, CAST(strlen(content) AS BIGINT) AS byte_size, COALESCE(code, 'valid') AS outcome,
      CASE WHEN code IS NULL THEN CAST(len(string_split(content, chr(10))) - 1 AS BIGINT) ELSE -1 END AS page_count
    FROM (SELECT *, CASE WHEN NOT starts_with(content, '%PDF-') THEN 'invalid_pdf_signature'
        WHEN strlen(content) > {v.LIMIT} THEN 'document_too_large' WHEN contains(content, '|') THEN 'corrupt_pdf'
        WHEN contains(content, '#') THEN 'encrypted_pdf' END AS code FROM v_objects)""")
def object_inspection(spark, sf):
    """Every stored object through a plugged-in inspector, which raises on some."""
    return fetch.inspect(v.objects(spark, sf), max_bytes=v.LIMIT, factory=line_inspector).select(
        "object_uri", "byte_size", F.coalesce("inspection_code", F.lit("valid")).alias("outcome"),
        F.coalesce("page_count", F.lit(-1).cast("bigint")).alias("page_count"))


@query("object_files")
def object_files(spark, sf):
    """The table files themselves as stored objects: scanned as binary files, those above a megabyte
    unread, the rest digested and tested for the signature of their format."""
    files = read_objects(spark, sf, v.BUCKET, sf, 1 << 20)
    return fetch.inspect(files, signature="PAR1", max_bytes=1 << 20).select(
        "object_uri", "byte_size", F.coalesce("inspection_code", F.lit("valid")).alias("outcome"), "content_sha256")


@query("type_route", """
    SELECT origin, id, CASE WHEN starts_with(content, '%PDF-') THEN 'application/pdf'
        WHEN starts_with(lower(ltrim(content)), '<!doctype html')
          OR starts_with(lower(ltrim(content)), '<html') THEN 'text/html'
        WHEN regexp_matches(content, '^(From|To|Subject|Received|Return-Path|MIME-Version): ')
          THEN 'message/rfc822'
        ELSE 'text/plain' END AS detected_type
    FROM (SELECT 'submission' AS origin, seq AS id, content FROM v_submissions
          UNION ALL SELECT 'page', page_id, html FROM pages
          UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations)""")
def type_route(spark, sf):
    rows = v.submissions(spark, sf).select(
        F.lit("submission").alias("origin"), F.col("seq").alias("id"), "content"
    ).unionAll(v.table(spark, sf, "pages").select(F.lit("page"), "page_id", "html")).unionAll(
        v.table(spark, sf, "conversations").select(
            F.lit("turn"), F.col("conv_id") * 1000 + F.col("turn"), "text"))
    return rows.select("origin", "id", detected_type("content").alias("detected_type"))


@query("sensitive_flags", "SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS {k}" for k, p in SENSITIVE.items())
    + " FROM documents")
def sensitive_flags(spark, sf):
    return v.text_table(spark, sf, "documents").select("doc_id", *sensitive_counts("text"))


@query("dedup_ledger", "SELECT tenant_id, event_id, event_offset FROM v_fresh")
def dedup_ledger(spark, sf):
    return fresh_events(v.submitted(spark, sf), v.ledger(spark, sf), schemas.FETCHER) \
        .select("tenant_id", "event_id", "event_offset")


@query("orphan_objects", """
    SELECT object_uri FROM v_remaining
    WHERE object_uri NOT IN (SELECT source_object_uri FROM v_prepared WHERE refusal IS NULL)""")
def orphan_objects_query(spark, sf):
    """Stored objects whose submission was refused."""
    kept = v.prepared(spark, sf).filter("refusal IS NULL")
    return orphan_objects(v.remaining_objects(spark, sf), kept).select("object_uri")


@query("missing_objects", """
    SELECT document_id, source_object_uri FROM v_versions
    WHERE source_object_uri NOT IN (SELECT object_uri FROM v_remaining)""")
def missing_objects_query(spark, sf):
    return missing_objects(v.stored_versions(spark, sf), v.remaining_objects(spark, sf)) \
        .select("document_id", "source_object_uri")


def verdicts(spark, sf, objects=v.objects):
    inspected = fetch.inspect(objects(spark, sf), max_bytes=v.LIMIT)
    return fetch.fetch_verdicts(
        v.submitted(spark, sf), inspected, v.stored_versions(spark, sf), v.ledger(spark, sf),
        bucket=v.BUCKET)


def settled(spark, sf):
    return fetch.with_metadata(verdicts(spark, sf).filter("quarantine IS NULL"), v.LIMIT)


def documents_after(spark, sf):
    return upsert(v.stored_documents(spark, sf), fetch.document_changes(settled(spark, sf)),
                  ["tenant_id", "id"], v.AS_OF)


@query("fetch_verdict", """
    SELECT document_id, event_offset, COALESCE(quarantine, code, 'valid') AS outcome
    FROM v_verdicts""")
def fetch_verdict(spark, sf):
    return verdicts(spark, sf).select(
        "document_id", "event_offset",
        F.coalesce("quarantine", "code", F.lit("valid")).alias("outcome"))


@query("fetch_twice_landed", """
    SELECT document_id, event_offset, COALESCE(quarantine, code, 'valid') AS outcome
    FROM v_verdicts""")
def fetch_twice_landed(spark, sf):
    """Every object landed twice: the verdicts stay those of objects landed once."""
    objects = v.objects(spark, sf)
    inspected = fetch.inspect(objects.unionByName(objects), max_bytes=v.LIMIT)
    return fetch.fetch_verdicts(
        v.submitted(spark, sf), inspected, v.stored_versions(spark, sf),
        v.ledger(spark, sf), bucket=v.BUCKET,
    ).select("document_id", "event_offset",
             F.coalesce("quarantine", "code", F.lit("valid")).alias("outcome"))


@query("fetch_summary", """
    SELECT COALESCE(quarantine, code, 'valid') AS outcome, COUNT(*) AS messages
    FROM v_verdicts GROUP BY 1""")
def fetch_summary(spark, sf):
    return outcome_counts(fetch_verdict(spark, sf), ["outcome"])


@query("fetch_quarantine", """
    SELECT document_id, parent_event_id AS event_id, quarantine AS reason FROM v_verdicts_after_loss
    WHERE quarantine IS NOT NULL""")
def fetch_quarantine(spark, sf):
    """Events with a bad URI, or of objects that were lost."""
    return fetch.quarantined(verdicts(spark, sf, v.remaining_objects)).select("document_id", "event_id", "reason")


_MESSAGES = "CASE code " + " ".join(
    f"WHEN '{c}' THEN '{m}'" for c, m in fetch.MESSAGES.items()) + " END"
_LIMITS = f'"max_document_bytes": {v.LIMIT}, "observed_bytes_at_rejection": {v.LIMIT + 1}'
_VALID = f"""'{{"declared_mime_type": "' || mime_type || '", "detected_mime_type": "application/pdf", "format": "pdf", "is_encrypted": false, "max_document_bytes": {v.LIMIT}}}'"""
_FAILED = f"""'{{"validation_error": "' || code || '", "message": "' || {_MESSAGES} || '"'
    || CASE code WHEN 'document_too_large' THEN ', {_LIMITS}' ELSE '' END || '}}'"""
_REJECTED = f"""'{{' || CASE code WHEN 'document_too_large' THEN '{_LIMITS}, ' ELSE '' END
    || '"validation_error": "' || code || '"}}'"""


@query("fetch_state_update", f"""
    WITH last_one AS (
      SELECT *, COALESCE({_FAILED}, {_VALID}) AS metadata FROM v_settled
      WHERE document_version_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY tenant_id, document_version_id
                                 ORDER BY event_offset DESC) = 1)
    SELECT v.id, CASE WHEN l.tenant_id IS NULL THEN 'pending' WHEN l.code IS NULL THEN 'valid'
        ELSE 'invalid' END AS inspection_status,
      CASE WHEN l.tenant_id IS NOT NULL AND l.code IS NULL THEN 'application/pdf' ELSE '' END
        AS detected_mime_type,
      COALESCE(l.metadata, '{{}}') AS inspection_metadata
    FROM v_versions v LEFT JOIN last_one l
      ON l.tenant_id = v.tenant_id AND l.document_version_id = v.id""")
def fetch_state_update(spark, sf):
    changed = upsert(v.stored_versions(spark, sf), fetch.version_changes(settled(spark, sf)),
                     ["tenant_id", "id"], v.AS_OF)
    return changed.select(
        "id", "inspection_status",
        F.coalesce("detected_mime_type", F.lit("")).alias("detected_mime_type"),
        "inspection_metadata")


@query("fetch_document_status", """
    WITH last_one AS (
      SELECT tenant_id, document_id, code FROM v_settled WHERE document_version_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY tenant_id, document_id
                                 ORDER BY event_offset DESC) = 1)
    SELECT v.document_id AS id, CASE WHEN l.tenant_id IS NULL THEN 'submitted'
        WHEN l.code IS NULL THEN 'fetched' ELSE 'failed' END AS status
    FROM v_versions v LEFT JOIN last_one l
      ON l.tenant_id = v.tenant_id AND l.document_id = v.document_id""")
def fetch_document_status(spark, sf):
    return documents_after(spark, sf).select("id", "status")


@query("fetch_failures", f"""
    SELECT document_version_id, parent_event_id AS event_id, code AS error_code,
      {_FAILED} AS error_detail
    FROM v_settled WHERE code IS NOT NULL AND document_version_id IS NOT NULL""")
def fetch_failures(spark, sf):
    return fetch.failure_rows(settled(spark, sf), v.AS_OF).select(
        "document_version_id", "event_id", "error_code", "error_detail")


@query("fetch_failures_rollup", f"""
    SELECT tenant_id, document_version_id, '{schemas.FETCHER}' AS stage, code AS error_code,
      CAST(COUNT(*) AS BIGINT) AS occurrence_count
    FROM v_settled WHERE code IS NOT NULL AND document_version_id IS NOT NULL
    GROUP BY ALL""")
def fetch_failures_rollup(spark, sf):
    return failure_rollup(fetch.failure_rows(settled(spark, sf), v.AS_OF)).select(
        "tenant_id", "document_version_id", "stage", "error_code", "occurrence_count")


_GOOD_ID = uuid_sql("tenant_id", "parent_event_id", "'DocumentFetched'")
_BAD_ID = uuid_sql("tenant_id", "parent_event_id", "'DocumentFetchRejected'")


def _head(event_id: str, event_type: str) -> str:
    return f"""'{{"event_id":"' || {event_id} || '","event_type":"{event_type}","occurred_at":"{ISO}"'
      || ',"correlation_id":"' || correlation_id || '","causation_id":"' || parent_event_id
      || '","tenant_id":"' || tenant_id || '","document_id":"' || document_id || '"'"""


@query("event_route_union", f"""
    WITH joined AS (
      SELECT s.*, o.content, {_VALID} AS good_meta, {_REJECTED} AS bad_meta
      FROM v_settled s LEFT JOIN v_objects o ON o.object_uri = s.payload_uri)
    SELECT {_GOOD_ID} AS event_id, '{schemas.DOCUMENT_FETCHED}' AS kafka_topic,
      document_version_id AS aggregate_id,
      {_head(_GOOD_ID, 'DocumentFetched')} || ',"document_version_id":"' || document_version_id
      || '","payload_uri":"' || payload_uri || '","detected_mime_type":"application/pdf"'
      || ',"content_sha256":"' || sha256(content) || '","byte_size":' || strlen(content)
      || ',"inspection_status":"valid","inspection_metadata":"'
      || replace(good_meta, '"', '\\"') || '","schema_version":"1.0.0"}}' AS payload
    FROM joined WHERE code IS NULL
    UNION ALL
    SELECT {_BAD_ID}, '{schemas.dead_letter_topic(schemas.FETCHER)}', document_id,
      {_head(_BAD_ID, 'DocumentFetchRejected')} || ',"payload_uri":"' || payload_uri
      || '","inspection_status":"invalid","inspection_metadata":"'
      || replace(bad_meta, '"', '\\"') || '","schema_version":"1.0.0"}}'
    FROM joined WHERE code IS NOT NULL""")
def event_route_union(spark, sf):
    # Both branches read the verdicts, which are therefore stored once.
    return fetch.fetch_outbox(cut_lineage(settled(spark, sf)), v.AS_OF).select(
        "event_id", "kafka_topic", "aggregate_id", "payload")


@query("retry_routing", f"""
    SELECT event_id, CASE WHEN value < 20 THEN '{schemas.CONTENT_EXTRACTED}'
      WHEN event_type <> 'error' AND attempt < 5 THEN '{schemas.retry_topic(schemas.EXTRACTOR)}'
      ELSE '{schemas.dead_letter_topic(schemas.EXTRACTOR)}' END AS topic
    FROM v_stage_events""")
def retry_routing(spark, sf):
    return v.stage_events(spark, sf).select("event_id", topic_for(
        F.col("value") < 20, F.col("attempt"), F.col("event_type") != "error",
        schemas.EXTRACTOR, schemas.CONTENT_EXTRACTED, 5).alias("topic"))


@query("landing_digests", """
    SELECT object_uri, tenant_id, sha256(content) AS content_sha256,
      CAST(strlen(content) AS BIGINT) AS byte_size FROM v_objects""")
def landing_digests(spark, sf):
    """Land every object in the shared folder, read it back and digest it again."""
    path = scratch(spark, "objects")
    land_objects(v.objects(spark, sf).withColumn("content_type", F.lit("application/pdf")), path)
    return read_landed(spark, path).select(
        "object_uri", "tenant_id",
        sha256("content").alias("content_sha256"),
        F.octet_length("content").cast("bigint").alias("byte_size"))
