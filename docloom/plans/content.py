"""Extraction, evidence and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id, sha256, stripped
from docloom.functions.json_text import canonical_json, strip_binary
from docloom.functions.keys import artifact_key
from docloom.functions.markup import figure_evidence, html_text
from docloom.operators import extraction as ext
from docloom.operators.metrics import outcome_counts, quality_by_tenant
from docloom.plans import views as v
from docloom.plans.registry import query, uuid_sql
from docloom.session import cut_lineage, scratch, spread
from docloom.sources.objects import bucketed, land_bucketed, read_artifacts, write_artifacts
from docloom.functions.markup import COMMENTS, HIDDEN_BLOCKS, SPACES, TAGS

EXTRACT_LIMIT = 20_000
SHORT_TEXT = 60
EXTRACTOR, EXTRACTOR_VERSION = "plain-text", "1"


def anchors(html):
    """Targets of the links of a page, in order."""
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)">'), F.lit(1))


def headings(html):
    return F.regexp_extract_all(html, F.lit("<h1>([^<]*)</h1>"), F.lit(1))


def page_tree(page):
    """A parser-like tree of a page: links stand for pictures, headings for tables. The first
    picture entry is a bare text and every picture carries image bytes."""
    pictures = F.concat(
        F.array(F.parse_json(F.lit('"cover"'))),
        F.transform(anchors("html"), lambda a: F.to_variant_object(F.struct(
            a.alias("self_ref"), F.array(a).alias("captions"), F.lit("AAAA").alias("image"),
            F.struct(F.lit("BBBB").alias("Data"), F.lit(1).alias("page_no")).alias("prov")))))
    tables = F.transform(headings("html"), lambda h: F.struct(h.alias("self_ref")))
    return page.withColumn("document", F.to_json(F.struct(
        F.col("page_id"), pictures.alias("pictures"), tables.alias("tables"))))


def converted_pages(spark, sf):
    """Pages through the column converter: no Python for the text itself."""
    return page_tree(v.text_table(spark, sf, "pages")).select(
        "page_id", "url", F.col("page_id").cast("string").alias("object_uri"),
        "document", html_text("html").alias("markdown"),
        F.lit(None).cast("string").alias("conversion_error"),
        F.octet_length("html").cast("bigint").alias("source_bytes"),
        sha256("html").alias("content_sha256"))


_LINKS = "regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1)"
_HEADS = "regexp_extract_all(html, '<h1>([^<]*)</h1>', 1)"
_TEXT = (f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
         f"'{HIDDEN_BLOCKS}', ' ', 'g'), '{COMMENTS}', ' ', 'g'), '{TAGS}', ' ', 'g'), "
         f"'{SPACES}', ' ', 'g'), ' ')")
_PICTURES = f"""'["cover"' || CASE WHEN len({_LINKS}) > 0 THEN ',' ELSE '' END || array_to_string(
    list_transform({_LINKS}, lambda a: '{{"captions":[' || to_json(a)
      || '],"prov":{{"page_no":1}},"self_ref":' || to_json(a) || '}}'), ',') || ']'"""
_TABLES = f"""'[' || array_to_string(list_transform({_HEADS},
    lambda h: '{{"self_ref":' || to_json(h) || '}}'), ',') || ']'"""
_FIGURES = f"""'[' || array_to_string(list_transform({_LINKS}, lambda a, i: '{{"captions":['
    || to_json(a) || '],"figure_index":' || i || ',"provenance":{{"page_no":1}},"self_ref":'
    || to_json(a) || '}}'), ',') || ']'"""

PAGE_SQL = f"""
    SELECT page_id, url, html, {_TEXT} AS markdown, {_LINKS} AS links, len({_HEADS}) AS n_tables,
      {_PICTURES} AS pictures, {_TABLES} AS tables, {_FIGURES} AS figures
    FROM pages"""


@query("strip_binary", f"""
    SELECT page_id, '{{"page_id":' || page_id || ',"pictures":' || pictures || ',"tables":'
      || tables || '}}' AS document FROM ({PAGE_SQL})""")
def strip_binary_query(spark, sf):
    trees = page_tree(v.text_table(spark, sf, "pages"))
    return trees.select("page_id", F.to_json(F.parse_json(strip_binary("document")))
                        .alias("document"))


@query("figure_evidence", """
    SELECT page_id, CAST(i AS BIGINT) AS figure_index, link AS self_ref,
      '[' || to_json(link) || ']' AS captions, '{"page_no":1}' AS provenance
    FROM (SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) AS i
          FROM (SELECT page_id, """ + _LINKS + """ AS links FROM pages))""")
def figure_evidence_query(spark, sf):
    trees = page_tree(v.text_table(spark, sf, "pages"))
    found = trees.select("page_id", F.inline(
        figure_evidence(F.parse_json(strip_binary("document")))))
    return found.select("page_id", "figure_index", "self_ref",
                        F.to_json("captions").alias("captions"),
                        F.to_json("provenance").alias("provenance"))


@query("html_normalize", f"""
    SELECT page_id, CAST(length(markdown) AS BIGINT) AS text_characters,
      CAST(n_tables AS BIGINT) AS table_count, CAST(len(links) AS BIGINT) AS figure_count,
      CASE WHEN markdown = '' THEN 'needs_review' ELSE 'succeeded' END AS extraction_status,
      '{{"document":{{"page_id":' || page_id || ',"pictures":' || pictures || ',"tables":' || tables
      || '}},"figures":' || figures || ',"format":"html","markdown":' || to_json(markdown)
      || ',"schema_version":"1.0.0","visual_interpretation":"not_performed"}}' AS body
    FROM ({PAGE_SQL})""")
def html_normalize(spark, sf):
    done = ext.normalize(converted_pages(spark, sf))
    return done.select(
        "page_id", "text_characters", "table_count", "figure_count",
        ext.extraction_status().alias("extraction_status"),
        ext.normalized_json("html").alias("body"))


@query("manifest_bodies", f"""
    SELECT page_id, '{{"extraction_status":"' || CASE WHEN markdown = '' THEN 'needs_review'
        ELSE 'succeeded' END || '","extractor":"{EXTRACTOR}","extractor_version":"1","quality":'
      || '{{"empty_text":' || CASE WHEN markdown = '' THEN 'true' ELSE 'false' END
      || ',"figure_count":' || len(links) || ',"source_bytes":' || strlen(html)
      || ',"table_count":' || n_tables || ',"text_characters":' || length(markdown)
      || ',"visual_interpretation":"not_performed"}},"source_content_sha256":"' || sha256(html)
      || '"}}' AS body
    FROM ({PAGE_SQL})""")
def manifest_bodies(spark, sf):
    return ext.normalize(converted_pages(spark, sf)).select(
        "page_id", ext.manifest_json(EXTRACTOR, EXTRACTOR_VERSION).alias("body"))


@query("artifact_keys", f"""
    SELECT id, tenant_id || '/' || id || '/extracted/' || content_sha256 || '/normalized.json'
      AS normalized_key,
      tenant_id || '/' || id || '/extracted/' || content_sha256 || '/manifest.json' AS manifest_key,
      '{{"bytes":' || byte_size || ',"type":' || to_json(mime_type) || '}}' AS facts
    FROM v_versions""")
def artifact_keys(spark, sf):
    parts = ("tenant_id", "id", "content_sha256")
    return v.stored_versions(spark, sf).select(
        "id", artifact_key(*parts, "normalized.json").alias("normalized_key"),
        artifact_key(*parts, "manifest.json").alias("manifest_key"),
        canonical_json(type=F.col("mime_type"), bytes=F.col("byte_size")).alias("facts"))


def text_converter():
    """Converter for the stored submissions: drops the signature line; very short texts count as
    unreadable and bytes without a signature as damaged."""
    def convert(content: bytes):
        text = content.decode("utf-8")
        if not text.startswith("%PDF-"):
            return None, None, "conversion_failed"
        body = text.split("\n", 1)[1]
        tables = sum(1 for line in body.split("\n") if "|" in line)
        document = '{"tables":[' + ",".join(["{}"] * tables) + "]}"
        return document, (body if len(body) >= SHORT_TEXT else " \n"), None

    return convert


def fetched_events(spark, sf):
    """One fetched event per version: some not validated, some with a stale digest or a stray
    type, some naming a version of another document."""
    d = F.col("document_id").cast("bigint")
    return v.stored_versions(spark, sf).select(
        derived_id(F.lit("fetched"), "document_id").alias("event_id"),
        F.when(d % 47 == 0, "DocumentTouched").otherwise("DocumentFetched").alias("event_type"),
        derived_id(F.lit("chain"), "document_id").alias("correlation_id"),
        "tenant_id", "document_id",
        F.when(d % 53 == 0, F.lit("no-such-version")).otherwise(F.col("id"))
        .alias("document_version_id"),
        F.col("source_object_uri").alias("payload_uri"),
        F.when(d % 17 == 0, "text/html").otherwise("application/pdf").alias("detected_mime_type"),
        F.when(d % 43 == 0, F.lit("0" * 64)).otherwise(F.col("content_sha256"))
        .alias("content_sha256"),
        F.when(d % 41 == 0, "pending").otherwise("valid").alias("inspection_status"),
        d.alias("event_offset"))


FETCHED_SQL = f"""
    SELECT {uuid_sql("'fetched'", 'document_id')} AS parent_event_id, v.*,
      CAST(document_id AS BIGINT) AS d,
      {uuid_sql("'chain'", 'document_id')} AS correlation_id,
      CASE WHEN d % 53 = 0 THEN 'no-such-version' ELSE id END AS event_version,
      CASE WHEN d % 43 = 0 THEN repeat('0', 64) ELSE v.content_sha256 END AS event_sha,
      o.content,
      CASE WHEN d % 47 = 0 THEN 'unexpected_event_type'
           WHEN d % 41 = 0 OR d % 17 = 0 THEN 'unsupported_source' END AS gate,
      CASE WHEN gate IS NULL AND o.object_uri IS NULL THEN 'missing_object' END AS quarantine,
      substr(o.content, position(chr(10) IN o.content) + 1) AS body,
      CASE WHEN quarantine IS NOT NULL THEN NULL
           WHEN gate IS NOT NULL THEN gate
           WHEN strlen(o.content) > {EXTRACT_LIMIT} THEN 'source_too_large'
           WHEN o.content = '' THEN 'empty_source'
           WHEN NOT starts_with(o.content, '%PDF-') THEN 'conversion_failed'
           WHEN sha256(o.content) <> event_sha THEN 'source_checksum_mismatch'
           WHEN is_deleted OR d % 53 = 0 OR d % 43 = 0 THEN 'unknown_document_version' END AS code,
      CASE WHEN length(body) < {SHORT_TEXT} THEN 0
           ELSE length(trim(body, ' ' || chr(9) || chr(10) || chr(13))) END AS characters,
      len(list_filter(string_split(CASE WHEN TRUE THEN body END, chr(10)),
                      lambda x: contains(x, '|'))) AS n_tables,
      CASE WHEN characters = 0 THEN 'needs_review' ELSE 'succeeded' END AS status
    FROM v_versions v LEFT JOIN v_objects o ON o.object_uri = v.source_object_uri"""


def _converted(spark, sf):
    return ext.normalize(ext.convert(
        spread(v.objects(spark, sf), "object_uri"), text_converter, EXTRACT_LIMIT))


def verdicts(spark, sf, normalized=None):
    empty = spark.createDataFrame([], schemas.TABLES["processed_events"])
    return ext.extract_verdicts(
        fetched_events(spark, sf), normalized or _converted(spark, sf),
        v.stored_versions(spark, sf), empty, bucket=v.BUCKET, artifact_bucket=v.ARTIFACTS)


def extracted(spark, sf):
    return ext.extract_outputs(
        cut_lineage(verdicts(spark, sf)), v.stored_versions(spark, sf), v.stored_documents(spark, sf),
        as_of=v.AS_OF, extractor=EXTRACTOR, extractor_version=EXTRACTOR_VERSION)


@query("extract_verdict", f"""
    SELECT document_id, COALESCE(quarantine, code, status) AS outcome FROM ({FETCHED_SQL})""")
def extract_verdict(spark, sf):
    return verdicts(spark, sf).select(
        "document_id", F.coalesce("quarantine", "code", "extraction_status").alias("outcome"))


@query("extract_summary", f"""
    SELECT COALESCE(quarantine, code, status) AS outcome, COUNT(*) AS messages
    FROM ({FETCHED_SQL}) GROUP BY 1""")
def extract_summary(spark, sf):
    return outcome_counts(extract_verdict(spark, sf), ["outcome"])


@query("extract_state_update", f"""
    WITH settled AS (SELECT * FROM ({FETCHED_SQL}) WHERE quarantine IS NULL AND d % 53 <> 0)
    SELECT v.id, CASE WHEN s.id IS NULL THEN 'pending' WHEN s.code IS NOT NULL THEN 'failed'
        ELSE s.status END AS extraction_status,
      CASE WHEN s.id IS NULL THEN '{{}}'
           WHEN s.code IS NOT NULL THEN '{{"error_code": "' || s.code || '"}}'
           ELSE '{{"empty_text": ' || CASE WHEN characters = 0 THEN 'true' ELSE 'false' END
             || ', "figure_count": 0, "source_bytes": ' || strlen(s.content)
             || ', "table_count": ' || n_tables || ', "text_characters": ' || characters
             || ', "visual_interpretation": "not_performed"}}' END AS extraction_metadata,
      CASE WHEN s.id IS NOT NULL AND s.code IS NULL THEN 's3://{v.ARTIFACTS}/' || s.tenant_id || '/'
        || s.id || '/extracted/' || s.content_sha256 || '/normalized.json' ELSE '' END
        AS normalized_object_uri
    FROM v_versions v LEFT JOIN settled s ON s.id = v.id""")
def extract_state_update(spark, sf):
    return extracted(spark, sf).versions.select(
        "id", "extraction_status", "extraction_metadata",
        F.coalesce("normalized_object_uri", F.lit("")).alias("normalized_object_uri"))


@query("extract_document_status", f"""
    SELECT document_id AS id, CASE WHEN quarantine IS NOT NULL THEN 'submitted'
        WHEN code IS NULL AND status = 'succeeded' THEN 'extracted' ELSE 'failed' END AS status
    FROM ({FETCHED_SQL})""")
def extract_document_status(spark, sf):
    return extracted(spark, sf).documents.select("id", "status")


@query("extract_outbox", f"""
    SELECT document_id, CASE WHEN code IS NULL THEN 'ContentExtracted'
        ELSE 'ContentExtractionRejected' END AS event_type,
      CASE WHEN code IS NULL THEN '{schemas.CONTENT_EXTRACTED}'
        ELSE '{schemas.dead_letter_topic(schemas.EXTRACTOR)}' END AS kafka_topic,
      parent_event_id AS causation_id, correlation_id, COALESCE(code, status) AS outcome
    FROM ({FETCHED_SQL}) WHERE quarantine IS NULL""")
def extract_outbox(spark, sf):
    def member(name):
        return F.get_json_object("payload", f"$.{name}")

    return extracted(spark, sf).outbox.select(
        member("document_id").alias("document_id"), "event_type", "kafka_topic",
        member("causation_id").alias("causation_id"),
        member("correlation_id").alias("correlation_id"),
        F.coalesce(member("error_code"), member("extraction_status")).alias("outcome"))


ARTIFACTS_SQL = f"""
    SELECT tenant_id, 's3://{v.ARTIFACTS}/' || tenant_id || '/' || event_version || '/extracted/'
        || event_sha || '/manifest.json' AS object_uri,
      '{{"extraction_status":"' || status || '","extractor":"{EXTRACTOR}","extractor_version":"1",'
      || '"quality":{{"empty_text":' || CASE WHEN characters = 0 THEN 'true' ELSE 'false' END
      || ',"figure_count":0,"source_bytes":' || strlen(content) || ',"table_count":' || n_tables
      || ',"text_characters":' || characters || ',"visual_interpretation":"not_performed"}}'
      || ',"source_content_sha256":"' || event_sha || '"}}' AS body
    FROM ({FETCHED_SQL})
    WHERE quarantine IS NULL AND (code IS NULL OR code = 'unknown_document_version')
    UNION ALL
    SELECT tenant_id, 's3://{v.ARTIFACTS}/' || tenant_id || '/' || event_version || '/extracted/'
        || event_sha || '/normalized.json',
      '{{"document":{{"tables":[' || array_to_string(list_transform(range(n_tables),
        lambda x: '{{}}'), ',') || ']}},"figures":[],"format":"pdf","markdown":'
      || to_json(CASE WHEN length(body) >= {SHORT_TEXT} THEN body ELSE ' ' || chr(10) END)
      || ',"schema_version":"1.0.0","visual_interpretation":"not_performed"}}'
    FROM ({FETCHED_SQL})
    WHERE quarantine IS NULL AND (code IS NULL OR code = 'unknown_document_version')"""


@query("artifact_bodies", ARTIFACTS_SQL)
def artifact_bodies(spark, sf):
    normalized = cut_lineage(_converted(spark, sf))
    return ext.artifacts(verdicts(spark, sf, normalized), normalized, fmt="pdf", extractor=EXTRACTOR,
                         extractor_version=EXTRACTOR_VERSION)


@query("artifact_store", f"SELECT tenant_id, object_uri, sha256(body) AS body_sha256 FROM ({ARTIFACTS_SQL})")
def artifact_store(spark, sf):
    """The extract stage over objects landed in buckets: converted documents are stored beside them,
    and the artifacts are written and read back."""
    root = scratch(spark, "extract")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    landed = land_bucketed(
        v.objects(spark, sf).withColumn("content_type", F.lit("application/pdf")), f"{root}/objects", buckets)
    empty = spark.createDataFrame([], schemas.TABLES["processed_events"])
    made = ext.extract_stage(
        fetched_events(spark, sf), landed, v.stored_versions(spark, sf), v.stored_documents(spark, sf), empty,
        factory=text_converter, bucket=v.BUCKET, artifact_bucket=v.ARTIFACTS, as_of=v.AS_OF, extractor=EXTRACTOR,
        extractor_version=EXTRACTOR_VERSION, max_bytes=EXTRACT_LIMIT, store=cut_lineage,
        store_bodies=lambda df: bucketed(df, f"{root}/bodies", "object_uri", buckets, dealt=True))
    write_artifacts(made.artifacts, f"{root}/artifacts")
    return read_artifacts(spark, f"{root}/artifacts").select("tenant_id", "object_uri", sha256("body").alias("body_sha256"))


@query("quality_by_tenant", f"""
    SELECT tenant_id, COUNT(*) AS documents, CAST(SUM(strlen(content)) AS BIGINT) AS source_bytes,
      CAST(SUM(characters) AS BIGINT) AS text_characters,
      CAST(SUM(n_tables) AS BIGINT) AS table_count, CAST(0 AS BIGINT) AS figure_count,
      COUNT(*) FILTER (WHERE status = 'needs_review') AS needs_review,
      ROUND(AVG(CASE WHEN status = 'needs_review' THEN 1.0 ELSE 0.0 END), 6) AS review_share
    FROM ({FETCHED_SQL}) WHERE quarantine IS NULL AND code IS NULL GROUP BY 1""")
def quality_by_tenant_query(spark, sf):
    good = verdicts(spark, sf).filter("quarantine IS NULL AND code IS NULL")
    return quality_by_tenant(good).withColumn("review_share", F.round("review_share", 6))


@query("review_labels", """
    SELECT source AS tenant_id, COUNT(*) AS documents,
      COUNT(*) FILTER (WHERE quality = 0) AS needs_review,
      COUNT(*) FILTER (WHERE quality IS NULL) AS pending,
      CAST(SUM(length(text)) AS BIGINT) AS characters
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def review_labels(spark, sf):
    """Review state per tenant from the given labels."""
    rows = v.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("tenant_id"), F.length("text").alias("characters"))
    return rows.join(v.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left") \
        .groupBy("tenant_id").agg(
            F.count(F.lit(1)).alias("documents"),
            F.count_if(F.col("quality") == 0).alias("needs_review"),
            F.count_if(F.col("quality").isNull()).alias("pending"),
            F.sum("characters").alias("characters"))


@query("text_lengths", """
    SELECT doc_id, CAST(length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS BIGINT)
      AS text_characters, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) = 0 AS empty_text
    FROM documents""")
def text_lengths(spark, sf):
    size = F.length(stripped("text")).cast("bigint")
    return v.text_table(spark, sf, "documents").select(
        "doc_id", size.alias("text_characters"), (size == 0).alias("empty_text"))
