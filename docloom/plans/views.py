"""Submissions, versions, objects and events derived from the given tables.

Everything follows from row values, so the SQL twins in ``SQL_VIEWS`` see the same rows. The
residues below only spread attributes (missing names, stray types, deletions) over all rows; no
view leaves rows out to make a check cheaper. ``remaining_objects`` alone lacks some: it stands for a
store that lost them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id
from docloom.operators import submission as sub
from docloom.operators.tables import conform
from docloom.plans.registry import uuid_sql
from docloom.session import spread

BUCKET = "sources"
ARTIFACTS = "artifacts"
AS_OF = "2024-01-16 00:00:00"
LIMIT = 5_000
WORKER = "worker-a"

_TYPES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(_TYPES[name]).parquet(f"{sf}/{name}.parquet")


def text_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose texts get heavy per-row work: see ``spread``."""
    return spread(table(spark, sf, name), {"documents": "doc_id", "pages": "page_id"}[name])


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same table as a file stream (the glob also fits a folder of parts)."""
    return spark.readStream.schema(_TYPES[name]).parquet(f"{sf}/{name}.parquet*")


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr(
        "doc_id AS seq", "source AS tenant_id", "CAST(doc_id AS STRING) AS document_id",
        "CASE WHEN doc_id % 31 = 0 THEN '' WHEN doc_id % 9 = 0 THEN concat(lang, '/', doc_id, '.pdf')"
        " ELSE concat(doc_id, '.pdf') END AS filename",
        "CASE doc_id % 3 WHEN 0 THEN concat('Title ', doc_id) WHEN 1 THEN '' END AS title",
        "CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('ext-', doc_id % 200) END"
        " AS source_external_id",
        "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'text/html'"
        " ELSE 'application/pdf' END AS mime_type",
        "CASE WHEN lang <> 'en' THEN lang END AS classification",
        "n_chars AS declared_bytes",
        "CASE WHEN doc_id % 19 = 0 THEN text ELSE concat('%PDF-1.7\\n', text) END AS content")


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return sub.screen(sub.prepare(submissions(spark, sf), BUCKET), LIMIT)


def tenants(spark: SparkSession, sf: str) -> DataFrame:
    """Tenants with a labelled document."""
    return table(spark, sf, "documents").select("doc_id", F.col("source").alias("id")) \
        .join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi") \
        .select("id").distinct()


def stored_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Version 1 of every submission that names a file (also of those later found too large)."""
    rows = prepared(spark, sf).filter("filename <> ''")
    return sub.version_rows(rows, AS_OF).withColumn(
        "deleted_at",
        F.when(F.col("document_id").cast("bigint") % 23 == 0, F.lit(AS_OF).cast("timestamp")))


def stored_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = prepared(spark, sf).filter("filename <> ''")
    return sub.document_rows(rows, AS_OF).withColumn(
        "deleted_at",
        F.when(F.col("id").cast("bigint") % 23 == 0, F.lit(AS_OF).cast("timestamp")))


def objects(spark: SparkSession, sf: str) -> DataFrame:
    """Stored bytes of every submission: some altered after it, some never registered."""
    return _objects(submissions(spark, sf))


def remaining_objects(spark: SparkSession, sf: str) -> DataFrame:
    """The same after those of one language were lost, for the queries that look for losses."""
    return _objects(submissions(spark, sf).filter(~F.col("classification").eqNullSafe(F.lit("es"))))


def _objects(kept: DataFrame) -> DataFrame:
    d = F.col("seq")
    key = sub.source_object_key("tenant_id", "document_id", "filename")
    return kept.select(
        sub.object_uri(BUCKET, key).alias("object_uri"), "tenant_id",
        F.when(d % 11 == 0, F.concat("content", F.lit("~"))).otherwise(F.col("content"))
        .alias("content"))


def submitted(spark: SparkSession, sf: str) -> DataFrame:
    """One event per submission, a second delivery of every fifth, some of a stray type."""
    rows = prepared(spark, sf)
    d = F.col("seq")
    copies = F.when(d % 5 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.explode(copies).alias("copy"), "seq", "tenant_id", "document_id", "source_object_uri",
        derived_id(F.lit("submitted"), "seq").alias("event_id"),
        derived_id(F.lit("chain"), "seq").alias("correlation_id"),
    ).selectExpr(
        "tenant_id", "document_id", "event_id",
        "IF(seq % 17 = 0, 'DocumentTouched', 'DocumentSubmitted') AS event_type",
        "correlation_id",
        "IF(seq % 37 = 0, concat('https://elsewhere/', document_id), source_object_uri)"
        " AS payload_uri",
        "seq * 2 + copy AS event_offset")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Events the fetcher handled before: those of documents labelled as poor."""
    poor = table(spark, sf, "labels").filter("quality = 0") \
        .select(F.col("doc_id").cast("string").alias("document_id"))
    return submitted(spark, sf).join(poor, "document_id", "left_semi").select(
        "tenant_id", "event_id", F.lit(schemas.FETCHER).alias("consumer_name"),
        F.lit(AS_OF).cast("timestamp").alias("processed_at"), F.lit("{}").alias("result"))


# Contract name of an outbox row: all five contracts, one that nobody declared, and none. Written
# for both engines, as the payload below.
CONTRACT_SQL = """CASE event_type WHEN 'click' THEN 'document-submitted' WHEN 'view' THEN 'document-fetched'
  WHEN 'purchase' THEN 'content-extracted'
  WHEN 'signup' THEN CASE WHEN number % 2 = 0 THEN 'document-fetch-rejected' ELSE 'content-extraction-rejected' END
  ELSE CASE WHEN number % 2 = 0 THEN 'chunks-created' ELSE '' END END"""

# A payload that fits each contract but for these rows: no occurred_at, no cause (which only a
# submitted event may lack), a null tenant, a size that is no number, no version.
PAYLOAD_SQL = "'{' || " + " || ',' || ".join([
    """'"event_id":"' || event_id || '","event_type":"' || event_type || '"'""",
    """CASE WHEN number % 11 = 1 THEN '"n":1' ELSE '"occurred_at":"2024-05-01T00:00:00Z"' END""",
    """'"correlation_id":"c-' || event_id || '"'""",
    """CASE WHEN number % 7 = 0 THEN '"causation_id":null' ELSE '"causation_id":"e-0"' END""",
    """CASE WHEN number % 11 = 2 THEN '"tenant_id":null' ELSE '"tenant_id":"' || tenant_id || '"' END""",
    *(f"""'"{name}":"v"'""" for name in (
        "document_id", "document_version_id", "payload_uri", "detected_mime_type", "content_sha256",
        "inspection_status", "inspection_metadata", "normalized_artifact_uri", "manifest_uri",
        "extractor_name", "extractor_version", "extraction_status", "quality_summary", "error_code")),
    """CASE WHEN number % 5 = 2 THEN '"byte_size":"7"' ELSE '"byte_size":7' END""",
    """CASE WHEN number % 11 = 3 THEN '"n":2' ELSE '"schema_version":"1.0.0"' END""",
]) + " || '}'"

# The first field that does not fit, in contract order.
MISFIT_SQL = """CASE WHEN number % 11 = 1 THEN 'occurred_at'
  WHEN number % 7 = 0 AND event_schema_name <> 'document-submitted' THEN 'causation_id'
  WHEN number % 11 = 2 THEN 'tenant_id'
  WHEN number % 5 = 2 AND event_schema_name = 'document-fetched' THEN 'byte_size'
  WHEN number % 11 = 3 THEN 'schema_version' END"""
STAGE_OF = {
    "click": "document-fetcher",
    "view": "content-extractor",
    "purchase": "chunker",
    "signup": "embedder",
    "error": "indexer",
}


def choose(column: str, mapping: dict[str, str]):
    return F.expr(choose_sql(column, mapping))


def choose_sql(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id", "event_id AS number",
        "CAST(ts AS TIMESTAMP) AS occurred_at", "CAST(user_id AS STRING) AS tenant_id",
        f"{choose_sql('event_type', STAGE_OF)} AS stage", "event_type", "value", "props",
        "CAST(event_id % 10 AS INT) AS attempt")


def outbox(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage_events(spark, sf).selectExpr(
        "event_id AS id", "tenant_id", "event_id", "'document' AS aggregate_type",
        "concat('doc-', tenant_id) AS aggregate_id", "event_type",
        "concat('log.', stage) AS kafka_topic",
        f"IF(number % 3 = 0, '', '{schemas.EVENT_NAMESPACE}') AS event_contract_namespace",
        f"{CONTRACT_SQL} AS event_schema_name", f"{PAYLOAD_SQL} AS payload",
        """concat('{"event_type":"', event_type, '"}') AS headers""",
        f"element_at(array{schemas.OUTBOX_STATUS}, CAST(number % 4 + 1 AS INT)) AS status",
        "attempt AS attempt_count", "occurred_at AS available_at",
        "IF(number % 4 = 1, occurred_at, NULL) AS locked_at",
        "CASE number % 8 WHEN 1 THEN 'worker-a' WHEN 5 THEN 'worker-b' END AS locked_by",
        "occurred_at AS created_at")
    return conform(rows, schemas.TABLES["ingestion_outbox"])


def text_of(ts):
    """Timestamps as text: engines print and hash them alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def text_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


_KEY = "tenant_id || '/' || document_id || '/original/' || " \
       "COALESCE(NULLIF(replace(replace(filename, '/', '_'), '\\', '_'), ''), 'upload')"
_D = "CAST(document_id AS BIGINT)"

VERDICTS_SQL = f"""
        SELECT e.tenant_id, e.event_id AS parent_event_id, e.event_offset, e.correlation_id,
          e.document_id, e.payload_uri, v.id AS document_version_id, v.mime_type,
          CASE WHEN NOT e.event_type = 'DocumentSubmitted' THEN NULL
               WHEN e.payload_uri NOT LIKE 's3://{BUCKET}/_%' THEN 'invalid_source_uri'
               WHEN o.object_uri IS NULL THEN 'missing_object' END AS quarantine,
          CASE WHEN v.id IS NULL THEN 'unknown_source_object'
               WHEN e.event_type <> 'DocumentSubmitted' THEN 'unexpected_event_type'
               WHEN NOT starts_with(o.content, '%PDF-') THEN 'invalid_pdf_signature'
               WHEN strlen(o.content) > {LIMIT} THEN 'document_too_large'
               WHEN sha256(o.content) <> v.content_sha256 THEN 'source_checksum_mismatch'
               WHEN v.mime_type NOT IN ('application/pdf', 'application/octet-stream')
                 THEN 'declared_mime_type_mismatch' END AS any_code,
          CASE WHEN quarantine IS NULL THEN any_code END AS code
        FROM v_fresh e
        LEFT JOIN {{objects}} o ON o.object_uri = e.payload_uri
        LEFT JOIN v_versions v ON v.tenant_id = e.tenant_id AND v.document_id = e.document_id
          AND v.source_object_uri = e.payload_uri AND NOT v.is_deleted"""

SQL_VIEWS = {
    "v_submissions": """
        SELECT doc_id AS seq, source AS tenant_id, CAST(doc_id AS VARCHAR) AS document_id,
          CASE WHEN doc_id % 31 = 0 THEN '' WHEN doc_id % 9 = 0 THEN lang || '/' || doc_id || '.pdf'
               ELSE doc_id || '.pdf' END AS filename,
          CASE WHEN doc_id % 3 = 0 THEN 'Title ' || doc_id WHEN doc_id % 3 = 1 THEN '' END AS title,
          CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN ''
               ELSE 'ext-' || (doc_id % 200) END AS source_external_id,
          CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL
               WHEN doc_id % 7 = 2 THEN 'text/html' ELSE 'application/pdf' END AS mime_type,
          CASE WHEN lang <> 'en' THEN lang END AS classification,
          n_chars AS declared_bytes,
          CASE WHEN doc_id % 19 = 0 THEN text ELSE '%PDF-1.7' || chr(10) || text END AS content
        FROM documents""",
    "v_prepared": f"""
        SELECT seq, tenant_id, document_id, filename,
          {uuid_sql('tenant_id', 'document_id', "'version'", '1')} AS document_version_id,
          COALESCE(NULLIF(source_external_id, ''), document_id) AS source_external_id,
          COALESCE(NULLIF(title, ''), filename) AS title,
          COALESCE(classification, 'internal') AS classification,
          COALESCE(NULLIF(mime_type, ''), 'application/octet-stream') AS mime_type,
          declared_bytes, CAST(strlen(content) AS BIGINT) AS byte_size,
          sha256(content) AS content_sha256,
          {_KEY} AS object_key,
          's3://{BUCKET}/' || {_KEY} AS source_object_uri,
          CASE WHEN declared_bytes > {LIMIT} THEN 413 WHEN COALESCE(filename, '') = '' THEN 422
               WHEN strlen(content) > {LIMIT} THEN 413 END AS refusal
        FROM v_submissions""",
    "v_tenants": """
        SELECT DISTINCT source AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "v_versions": f"""
        SELECT document_version_id AS id, tenant_id, document_id, 1 AS version_number,
          content_sha256, source_object_uri, mime_type, byte_size,
          {_D} % 23 = 0 AS is_deleted
        FROM v_prepared WHERE filename <> ''""",
    "v_objects": f"""
        SELECT 's3://{BUCKET}/' || {_KEY} AS object_uri, tenant_id,
          CASE WHEN seq % 11 = 0 THEN content || '~' ELSE content END AS content,
          classification IS NOT DISTINCT FROM 'es' AS lost
        FROM v_submissions""",
    "v_remaining": "SELECT * FROM v_objects WHERE NOT lost",
    "v_submitted": f"""
        SELECT tenant_id, document_id, {uuid_sql("'submitted'", 'seq')} AS event_id,
          CASE WHEN seq % 17 = 0 THEN 'DocumentTouched' ELSE 'DocumentSubmitted' END AS event_type,
          {uuid_sql("'chain'", 'seq')} AS correlation_id,
          CASE WHEN seq % 37 = 0 THEN 'https://elsewhere/' || document_id
               ELSE source_object_uri END AS payload_uri,
          seq * 2 + copy AS event_offset
        FROM v_prepared, (VALUES (0), (1)) AS c(copy)
        WHERE copy = 0 OR seq % 5 = 0""",
    "v_ledger": """
        SELECT DISTINCT tenant_id, event_id FROM v_submitted
        WHERE CAST(document_id AS BIGINT) IN (SELECT doc_id FROM labels WHERE quality = 0)""",
    "v_fresh": """
        SELECT * FROM v_submitted s
        WHERE NOT EXISTS (SELECT 1 FROM v_ledger l
                          WHERE l.tenant_id = s.tenant_id AND l.event_id = s.event_id)
        QUALIFY row_number() OVER (PARTITION BY tenant_id, event_id ORDER BY event_offset) = 1""",
    "v_verdicts": VERDICTS_SQL.format(objects="v_objects"),
    "v_verdicts_after_loss": VERDICTS_SQL.format(objects="v_remaining"),
    "v_settled": "SELECT * FROM v_verdicts WHERE quarantine IS NULL",
    "v_stage_events": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS number, ts AS occurred_at,
          CAST(user_id AS VARCHAR) AS tenant_id, {choose_sql('event_type', STAGE_OF)} AS stage,
          event_type, value, props, CAST(event_id % 10 AS INTEGER) AS attempt
        FROM events""",
    "v_outbox": f"""
        SELECT event_id AS id, tenant_id, event_id, 'doc-' || tenant_id AS aggregate_id, event_type,
          'log.' || stage AS kafka_topic,
          CASE WHEN number % 3 = 0 THEN '' ELSE '{schemas.EVENT_NAMESPACE}' END
            AS event_contract_namespace,
          {CONTRACT_SQL} AS event_schema_name, {PAYLOAD_SQL} AS payload, number,
          CASE number % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'publishing' WHEN 2 THEN 'published'
               ELSE 'failed' END AS status,
          attempt AS attempt_count, occurred_at AS available_at,
          CASE number % 8 WHEN 1 THEN 'worker-a' WHEN 5 THEN 'worker-b' END AS locked_by,
          occurred_at AS created_at
        FROM v_stage_events""",
    "v_resolved": f"""
        SELECT *, COALESCE(NULLIF(event_contract_namespace, ''), '{schemas.EVENT_NAMESPACE}')
            AS contract_namespace,
          NULLIF(event_schema_name, '') AS schema_name,
          CASE WHEN NULLIF(event_schema_name, '') IS NULL
                 THEN 'Outbox event is missing its checked-in event schema name.'
               WHEN event_schema_name NOT IN ({', '.join(f"'{c}'" for c in schemas.CONTRACTS)})
                 THEN 'No checked-in schema is configured for ' || COALESCE(
                   NULLIF(event_contract_namespace, ''), '{schemas.EVENT_NAMESPACE}')
                   || '/' || event_schema_name || '.'
               WHEN {MISFIT_SQL} IS NOT NULL
                 THEN 'Payload does not fit ' || COALESCE(
                   NULLIF(event_contract_namespace, ''), '{schemas.EVENT_NAMESPACE}')
                   || '/' || event_schema_name || ': ' || {MISFIT_SQL} || '.' END AS error
        FROM v_outbox""",
}
