"""Tenancy, versions, access, audit and lineage queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id
from docloom.operators import access, audits, lineage, metrics, tables
from docloom.plans import content, delivery, ingest
from docloom.plans import views as v
from docloom.plans.registry import query

TENANT = "src3"
CALLER = ("group:3", "user:q0", "role:de")


@query("tenant_scope", f"SELECT id, document_id FROM v_versions WHERE tenant_id = '{TENANT}'")
def tenant_scope(spark, sf):
    return tables.tenant_scope(v.stored_versions(spark, sf), TENANT).select("id", "document_id")


@query("tenant_unset", """
    SELECT name AS tenant_id, COUNT(v.id) AS visible FROM (
      SELECT DISTINCT tenant_id AS name FROM v_versions UNION ALL SELECT NULL) s
    LEFT JOIN v_versions v ON v.tenant_id = s.name GROUP BY 1""")
def tenant_unset(spark, sf):
    """What every session sees of all versions: one session per tenant, and one without a tenant."""
    rows = v.stored_versions(spark, sf)
    sessions = rows.select("tenant_id").distinct().union(spark.createDataFrame([(None,)], "tenant_id string"))
    seen = tables.session_scope(rows, sessions.select(F.col("tenant_id").alias("session")), "session")
    return sessions.join(seen.groupBy(F.col("session").alias("tenant_id")).agg(F.count("id").alias("visible")),
                         "tenant_id", "left").select("tenant_id", F.coalesce("visible", F.lit(0)).alias("visible"))


@query("tenant_write_check", f"""
    SELECT tenant_id, COUNT(*) AS rejected FROM v_versions WHERE tenant_id <> '{TENANT}' GROUP BY 1
    """)
def tenant_write_check(spark, sf):
    """Rows a write under one tenant must refuse."""
    return metrics.outcome_counts(
        tables.outside_scope(v.stored_versions(spark, sf), TENANT), ["tenant_id"], "rejected")


def numbered_versions(spark, sf):
    """Versions whose document is the external id: one per submission, numbered in its order."""
    rows = v.prepared(spark, sf).select(
        "tenant_id", F.col("source_external_id").alias("document_id"),
        F.col("document_version_id").alias("id"), "seq",
        F.when(F.col("seq") % 23 == 0, F.lit(v.AS_OF).cast("timestamp")).alias("deleted_at"))
    none = spark.createDataFrame([], "tenant_id string, document_id string, version_number int")
    return tables.number_versions(rows, none, "seq")


_NUMBERED = """
    SELECT document_version_id AS id, tenant_id, source_external_id AS document_id, seq,
      CAST(row_number() OVER (PARTITION BY tenant_id, source_external_id ORDER BY seq) AS INTEGER)
        AS version_number
    FROM v_prepared"""


@query("version_numbers", f"SELECT id, document_id, version_number FROM ({_NUMBERED})")
def version_numbers(spark, sf):
    return numbered_versions(spark, sf).select("id", "document_id", "version_number")


@query("active_versions", f"""
    SELECT tenant_id, document_id, id, version_number FROM ({_NUMBERED}) WHERE seq % 23 <> 0
    QUALIFY row_number() OVER (PARTITION BY tenant_id, document_id
                               ORDER BY version_number DESC) = 1""")
def active_versions(spark, sf):
    return tables.latest_versions(numbered_versions(spark, sf)) \
        .select("tenant_id", "document_id", "id", "version_number")


@query("current_pointer", """
    SELECT p.document_id, p.document_version_id AS current_version_id,
      CAST(1 AS INTEGER) AS current_version_number, p.content_sha256 AS current_content_sha256
    FROM v_prepared p WHERE filename <> ''""")
def current_pointer(spark, sf):
    return tables.current_versions(
        v.stored_documents(spark, sf), v.stored_versions(spark, sf)).select(
        F.col("id").alias("document_id"), "current_version_id", "current_version_number",
        "current_content_sha256")


@query("upsert_titles", f"""
    SELECT c_custkey, COALESCE(n.title, c_name) AS title,
      CASE WHEN n.o_custkey IS NULL THEN '' ELSE '{v.AS_OF}.000000' END AS updated_at
    FROM customer LEFT JOIN (SELECT o_custkey, 'orders:' || COUNT(*) AS title FROM orders
                             GROUP BY 1) n ON n.o_custkey = c_custkey""")
def upsert_titles(spark, sf):
    """Lay one change per customer, taken from the orders, over the customer table."""
    base = v.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("title"),
        F.lit(None).cast("timestamp").alias("updated_at"))
    changes = metrics.outcome_counts(
        v.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"], "n").select("c_custkey", F.concat(F.lit("orders:"), "n").alias("title"))
    return tables.upsert(base, changes, ["c_custkey"], v.AS_OF).select(
        "c_custkey", "title", F.coalesce(v.text_of("updated_at"), F.lit("")).alias("updated_at"))


# Access -----------------------------------------------------------------------------------------


def acl(spark, sf):
    """Groups from the vector labels, roles from the languages, users from the quality labels."""
    docs = v.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("tenant_id"), "lang")
    groups = v.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    users = v.table(spark, sf, "labels").select("doc_id", "quality")

    def rows(df, kind, who, permission):
        return df.select(
            "tenant_id", F.col("doc_id").cast("string").alias("document_id"),
            F.lit(kind).alias("principal_type"), who.cast("string").alias("principal_id"),
            F.lit(permission).alias("permission"))

    out = rows(docs, "role", F.col("lang"), "read") \
        .unionByName(rows(docs.join(groups, "doc_id"), "group", F.col("label"), "read")) \
        .unionByName(rows(docs.join(users, "doc_id"), "user",
                          F.concat(F.lit("q"), F.col("quality")), "manage"))
    return out.withColumn("id", derived_id(
        "tenant_id", "document_id", "principal_type", "principal_id", "permission")) \
        .withColumn("created_at", F.lit(v.AS_OF).cast("timestamp"))


ACL_SQL = """
    SELECT source AS tenant_id, CAST(doc_id AS VARCHAR) AS document_id, 'role:' || lang AS principal,
      'read' AS permission FROM documents
    UNION ALL SELECT source, CAST(doc_id AS VARCHAR), 'group:' || label, 'read'
      FROM documents JOIN embeddings ON vec_id = doc_id
    UNION ALL SELECT source, CAST(doc_id AS VARCHAR), 'user:q' || quality, 'manage'
      FROM documents JOIN labels USING (doc_id)"""
CALLER_SQL = ", ".join(f"'{p}'" for p in CALLER)


@query("acl_principals", f"""
    SELECT tenant_id, document_id, array_to_string(list_sort(list(DISTINCT principal)), ',')
      AS principals FROM ({ACL_SQL}) GROUP BY 1, 2""")
def acl_principals(spark, sf):
    return access.acl_principals(acl(spark, sf)).select(
        "tenant_id", "document_id", F.array_join("acl_principals", ",").alias("principals"))


@query("acl_semi", f"""
    SELECT document_id AS id, tenant_id FROM v_versions
    WHERE NOT is_deleted AND (tenant_id, document_id) IN
      (SELECT (tenant_id, document_id) FROM ({ACL_SQL}) WHERE principal IN ({CALLER_SQL}))""")
def acl_semi(spark, sf):
    return access.readable_documents(
        v.stored_documents(spark, sf), acl(spark, sf), CALLER).select("id", "tenant_id")


@query("acl_manage_only", f"""
    SELECT document_id AS id, tenant_id FROM v_versions
    WHERE NOT is_deleted AND (tenant_id, document_id) IN (SELECT (tenant_id, document_id)
      FROM ({ACL_SQL}) WHERE principal IN ({CALLER_SQL}) AND permission = 'manage')""")
def acl_manage_only(spark, sf):
    return access.readable_documents(
        v.stored_documents(spark, sf), acl(spark, sf), CALLER, ("manage",)) \
        .select("id", "tenant_id")


# Funnels ----------------------------------------------------------------------------------------


_STATUS = """
    WITH last_one AS (
      SELECT tenant_id, document_id, code FROM v_settled WHERE document_version_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY tenant_id, document_id
                                 ORDER BY event_offset DESC) = 1),
    states AS (
      SELECT v.tenant_id, CASE WHEN l.tenant_id IS NULL THEN 'submitted'
        WHEN l.code IS NULL THEN 'fetched' ELSE 'failed' END AS status
      FROM v_versions v LEFT JOIN last_one l
        ON l.tenant_id = v.tenant_id AND l.document_id = v.document_id WHERE NOT v.is_deleted)"""


@query("status_funnel", f"""{_STATUS}
    SELECT tenant_id, status, COUNT(*) AS documents FROM states GROUP BY ALL""")
def status_funnel(spark, sf):
    return metrics.status_funnel(ingest.documents_after(spark, sf))


@query("status_matrix", f"""{_STATUS}
    SELECT tenant_id, COUNT(*) FILTER (WHERE status = 'submitted') AS submitted,
      COUNT(*) FILTER (WHERE status = 'fetched') AS fetched,
      COUNT(*) FILTER (WHERE status = 'failed') AS failed FROM states GROUP BY 1""")
def status_matrix(spark, sf):
    return metrics.status_matrix(
        ingest.documents_after(spark, sf), ["submitted", "fetched", "failed"])


# Audits -----------------------------------------------------------------------------------------


def _tenant_rows(spark, sf):
    now = F.lit(v.AS_OF).cast("timestamp")
    return v.tenants(spark, sf).select(
        "id", F.col("id").alias("slug"), F.concat(F.lit("Tenant "), "id").alias("display_name"),
        F.lit("active").alias("status"), now.alias("created_at"), now.alias("updated_at"))


AUDITED = ("tenants", "documents", "document_versions", "document_acl", "chunks", "ingestion_outbox",
           "processed_events", "ingestion_failures", "audit_log")
_NOW = f"TIMESTAMP '{v.AS_OF}'"

# The audited tables over the SQL views, with the columns the rules name.
AUDITED_SQL = {
    "tenants": f"""SELECT id, id AS slug, 'Tenant ' || id AS display_name, 'active' AS status,
        {_NOW} AS created_at, {_NOW} AS updated_at FROM v_tenants""",
    "documents": f"""SELECT document_id AS id, tenant_id, 'api' AS source_system, source_external_id, classification,
        'submitted' AS status, document_version_id AS current_version_id, {_NOW} AS created_at, {_NOW} AS updated_at
        FROM v_prepared WHERE filename <> ''""",
    "document_versions": f"""SELECT id, tenant_id, document_id, version_number, content_sha256, source_object_uri, mime_type,
        byte_size, '{{}}' AS extraction_config, '{{}}' AS extraction_metadata, '{{}}' AS model_versions,
        'pending' AS inspection_status, '{{}}' AS inspection_metadata, 'pending' AS extraction_status,
        {_NOW} AS created_at, {_NOW} AS updated_at FROM v_versions""",
    "document_acl": f"""SELECT tenant_id || document_id || principal || permission AS id, tenant_id, document_id,
        split_part(principal, ':', 1) AS principal_type, split_part(principal, ':', 2) AS principal_id, permission,
        {_NOW} AS created_at FROM ({ACL_SQL})""",
    "chunks": f"""SELECT id, tenant_id, document_version_id, chunk_index, point_id, content_sha256, NULL AS page_from,
        NULL AS page_to, anchor AS section_path, token_count, length(chunk_text) AS character_count, TRUE AS is_active,
        'given' AS embedding_model, '1' AS embedding_model_version, 'token-window' AS chunking_strategy,
        {_NOW} AS created_at FROM ({{chunks}})""",
    "ingestion_outbox": """SELECT id, tenant_id, event_id, 'document' AS aggregate_type, aggregate_id, event_type, kafka_topic,
        event_contract_namespace, event_schema_name, payload, '{}' AS headers, status, attempt_count, available_at,
        created_at FROM v_outbox""",
    "processed_events": f"""SELECT tenant_id, event_id, '{schemas.FETCHER}' AS consumer_name, {_NOW} AS processed_at,
        '{{}}' AS result FROM v_submitted
        WHERE CAST(document_id AS BIGINT) IN (SELECT doc_id FROM labels WHERE quality = 0)""",
    "ingestion_failures": """SELECT event_id AS id, tenant_id, 'v-' || (number % 500) AS document_version_id, stage,
        NULL AS error_class, event_type AS error_code, NULL AS error_detail, occurred_at AS first_seen_at,
        occurred_at AS last_seen_at, 1 AS occurrence_count FROM v_stage_events""",
    "audit_log": """SELECT number AS id, tenant_id, NULL AS actor_type, NULL AS actor_id, event_type AS action,
        NULL AS entity_type, NULL AS entity_id, NULL AS metadata, occurred_at FROM v_stage_events""",
}


def audit_sql(tables: dict[str, str]) -> str:
    """Every declared rule evaluated by itself: predicates, distinct keys, missing parents."""
    parts = []

    def rule(table: str, name: str, count: str) -> None:
        parts.append(f"SELECT '{table}' AS \"table\", '{name}' AS rule, CAST({count} AS BIGINT) AS violations")

    for t in tables:
        for c in schemas.CHECKS:
            if c.table == t:
                valid = re.sub(r"(\w+) RLIKE ('[^']*')", r"regexp_matches(\1, \2)", c.valid)
                rule(t, c.rule, f"(SELECT COUNT(*) FILTER (WHERE NOT ({valid})) FROM a_{t})")
        for c in schemas.NOT_NULL[t]:
            rule(t, f"{c}_not_null", f"(SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM a_{t})")
        for k in schemas.UNIQUE_KEYS:
            if k.table == t:
                there = " AND ".join(f"{c} IS NOT NULL" for c in k.columns)
                rule(t, "unique_" + "_".join(k.columns),
                     f"(SELECT COUNT(*) - COUNT(DISTINCT ({', '.join(k.columns)})) FROM a_{t} WHERE {there})")
        for f in schemas.FOREIGN_KEYS:
            if f.table == t and f.parent in tables:
                there = " AND ".join(f"c.{c} IS NOT NULL" for c in f.columns)
                same = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(f.columns, f.parent_columns))
                rule(t, f"{'_'.join(f.columns)}_in_{f.parent}",
                     f"(SELECT COUNT(*) FROM a_{t} c WHERE {there} AND NOT EXISTS (SELECT 1 FROM a_{f.parent} p WHERE {same}))")
    views = ", ".join(f"a_{t} AS ({sql})" for t, sql in tables.items())
    return f"WITH {views} " + " UNION ALL ".join(parts)


def audited_tables(spark, sf):
    """All nine tables."""
    from docloom.plans import search  # which builds on this module

    log = v.stage_events(spark, sf).selectExpr(
        "number AS id", "tenant_id", "event_type AS action", "occurred_at")
    return {
        "tenants": _tenant_rows(spark, sf),
        "documents": v.stored_documents(spark, sf),
        "document_versions": v.stored_versions(spark, sf),
        "document_acl": acl(spark, sf),
        "chunks": search.chunks(spark, sf),
        "ingestion_outbox": v.outbox(spark, sf),
        "processed_events": v.ledger(spark, sf),
        "ingestion_failures": tables.conform(delivery.failures(spark, sf), schemas.TABLES["ingestion_failures"]),
        "audit_log": tables.conform(log, schemas.TABLES["audit_log"]),
    }


@query("key_audit", """
    SELECT 'orders' AS "table", 'unique_o_orderkey' AS rule,
      COUNT(o_orderkey) - COUNT(DISTINCT o_orderkey) AS violations FROM orders
    UNION ALL SELECT 'orders', 'unique_o_custkey_o_orderdate',
      COUNT(*) - COUNT(DISTINCT (o_custkey, o_orderdate)) FROM orders
    UNION ALL SELECT 'lineitem', 'unique_l_orderkey_l_linenumber',
      COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 'lineitem', 'unique_l_partkey_l_suppkey',
      COUNT(*) - COUNT(DISTINCT (l_partkey, l_suppkey)) FROM lineitem""")
def key_audit(spark, sf):
    orders, lines = v.table(spark, sf, "orders"), v.table(spark, sf, "lineitem")
    return audits.union_all([
        audits.key_check("orders", orders, ["o_orderkey"]),
        audits.key_check("orders", orders, ["o_custkey", "o_orderdate"]),
        audits.key_check("lineitem", lines, ["l_orderkey", "l_linenumber"]),
        audits.key_check("lineitem", lines, ["l_partkey", "l_suppkey"]),
    ])


@query("fk_audit", """
    SELECT 'orders' AS "table", 'o_custkey_in_customer' AS rule, COUNT(*) AS violations
      FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'lineitem', 'l_orderkey_in_orders', COUNT(*)
      FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'lineitem', 'l_partkey_in_part', COUNT(*)
      FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'labels', 'doc_id_in_documents', COUNT(*)
      FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
    UNION ALL SELECT 'documents', 'doc_id_in_labels', COUNT(*)
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def fk_audit(spark, sf):
    t = {name: v.table(spark, sf, name)
         for name in ("orders", "customer", "lineitem", "part", "labels", "documents")}
    return audits.union_all([
        audits.reference_check("orders", t["orders"], ["o_custkey"], t["customer"],
                               ["c_custkey"], "customer"),
        audits.reference_check("lineitem", t["lineitem"], ["l_orderkey"], t["orders"],
                               ["o_orderkey"], "orders"),
        audits.reference_check("lineitem", t["lineitem"], ["l_partkey"], t["part"],
                               ["p_partkey"], "part"),
        audits.reference_check("labels", t["labels"], ["doc_id"], t["documents"], ["doc_id"],
                               "documents"),
        audits.reference_check("documents", t["documents"], ["doc_id"], t["labels"], ["doc_id"],
                               "labels"),
    ])


@query("check_audit", """
    SELECT 'lineitem' AS "table", unnest(['quantity_large', 'status_value', 'l_shipdate_not_null'])
        AS rule,
      unnest([COUNT(*) FILTER (WHERE NOT (l_quantity <= 45)),
              COUNT(*) FILTER (WHERE NOT (l_linestatus IN ('O'))),
              COUNT(*) FILTER (WHERE l_shipdate IS NULL)]) AS violations FROM lineitem
    UNION ALL
    SELECT 'documents', unnest(['lang_shape', 'text_not_short', 'source_not_null']),
      unnest([COUNT(*) FILTER (WHERE NOT regexp_matches(lang, '^[a-z]{2}$')),
              COUNT(*) FILTER (WHERE NOT (length(text) >= 100)),
              COUNT(*) FILTER (WHERE source IS NULL)]) FROM documents""")
def check_audit(spark, sf):
    return audits.union_all([
        audits.row_checks("lineitem", v.table(spark, sf, "lineitem"), {
            "quantity_large": "l_quantity <= 45", "status_value": "l_linestatus IN ('O')",
        }, ["l_shipdate"]),
        audits.row_checks("documents", v.table(spark, sf, "documents"), {
            "lang_shape": "lang RLIKE '^[a-z]{2}$'", "text_not_short": "length(text) >= 100",
        }, ["source"]),
    ])


@query("terminal_status", f"""
    SELECT v.id, v.document_id FROM v_versions v
    WHERE v.id IN (SELECT id FROM ({content.FETCHED_SQL}) WHERE quarantine IS NOT NULL)
       OR CAST(v.document_id AS BIGINT) % 53 = 0""")
def terminal_status(spark, sf):
    """Versions that did not reach a final extraction state."""
    final = [s for s in schemas.EXTRACTION_STATUS if s != "pending"]
    return audits.unfinished(
        content.extracted(spark, sf).versions, "extraction_status", final) \
        .select("id", "document_id")


# Chains -----------------------------------------------------------------------------------------


def turns(spark, sf):
    """Conversations as event chains: each turn is caused by the one before it."""
    def turn_id(turn):
        return F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))

    return v.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("correlation_id"),
        turn_id(F.col("turn")).alias("event_id"),
        F.when(F.col("turn") > 0, turn_id(F.col("turn") - 1)).alias("causation_id"),
        F.col("role").alias("event_type"))


@query("chain_lineage", """
    SELECT c.conv_id || ':' || c.turn AS event_id, p.conv_id || ':' || p.turn AS causation_id,
      c.role AS event_type, p.role AS parent_type
    FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""")
def chain_lineage(spark, sf):
    return lineage.causal_links(turns(spark, sf)).select(
        "event_id", "causation_id", "event_type", "parent_type")


@query("stage_latency", """
    SELECT event_id, tenant_id AS correlation_id, CAST(COALESCE(epoch_us(occurred_at) - epoch_us(
      lag(occurred_at) OVER (PARTITION BY tenant_id ORDER BY occurred_at, event_id)), -1)
      AS BIGINT) AS latency_us
    FROM v_stage_events""")
def stage_latency(spark, sf):
    chained = v.stage_events(spark, sf).select(
        "event_id", F.col("tenant_id").alias("correlation_id"), "occurred_at")
    return lineage.stage_latency(chained).select(
        "event_id", "correlation_id", F.coalesce("latency_us", F.lit(-1)).alias("latency_us"))
