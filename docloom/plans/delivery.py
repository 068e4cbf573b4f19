"""Outbox, topic and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import metrics
from docloom.operators import outbox as box
from docloom.plans import views as v
from docloom.plans.registry import query
from docloom.sources.event_log import decode, encode, missing_topics, retain, topic_specs
from docloom.streaming.flows import outcome_windows

DUE = f"status IN ('pending', 'failed') AND available_at <= TIMESTAMP '{v.AS_OF}'"


@query("outbox_claim", f"""
    SELECT id, 'publishing' AS status, CAST(attempt_count + 1 AS INTEGER) AS attempt_count,
      '{v.WORKER}' AS locked_by, {v.text_sql('available_at')} AS available_at
    FROM v_outbox WHERE {DUE} ORDER BY v_outbox.available_at, created_at, id LIMIT 50""")
def outbox_claim(spark, sf):
    return box.claim(v.outbox(spark, sf), v.AS_OF, 50, v.WORKER).select(
        "id", "status", "attempt_count", "locked_by",
        v.text_of("available_at").alias("available_at"))


@query("outbox_claim_applied", f"""
    WITH picked AS (SELECT id FROM v_outbox WHERE {DUE}
                    ORDER BY available_at, created_at, id LIMIT 1000)
    SELECT id, CASE WHEN id IN (FROM picked) THEN 'publishing' ELSE status END AS status,
      CAST(attempt_count + CAST(id IN (FROM picked) AS INTEGER) AS INTEGER) AS attempt_count
    FROM v_outbox""")
def outbox_claim_applied(spark, sf):
    outbox = v.outbox(spark, sf)
    return box.apply_claim(outbox, box.claim(outbox, v.AS_OF, 1000, v.WORKER)) \
        .select("id", "status", "attempt_count")


@query("outbox_envelope", f"""
    SELECT id, kafka_topic AS topic, tenant_id || ':' || aggregate_id AS key, payload AS value,
      'event_type=' || event_type || ';content-type=application/json'
      || ';event-contract-namespace=' || contract_namespace
      || ';event-schema-name=' || COALESCE(schema_name, '?') || ';schema-version='
      || CASE WHEN number % 11 = 3 THEN '?' ELSE '1.0.0' END AS headers,
      COALESCE(error, '') AS error
    FROM v_resolved WHERE {DUE}""")
def outbox_envelope(spark, sf):
    """Every due row, not only one batch."""
    due = box.claimable(v.outbox(spark, sf), v.AS_OF)
    return box.envelope(due, box.registry(spark)).select(
        "id", "topic", "key", "value",
        F.array_join(F.transform("headers", lambda h: F.concat(
            h["key"], F.lit("="), F.coalesce(h["value"].cast("string"), F.lit("?")))), ";")
        .alias("headers"),
        F.coalesce("error", F.lit("")).alias("error"))


def _outcomes(spark, sf):
    held = v.outbox(spark, sf).filter("status = 'publishing'")
    return box.outcomes_of(box.envelope(held, box.registry(spark)), v.AS_OF)


@query("outbox_complete", f"""
    SELECT id, CASE WHEN NOT hit THEN status WHEN error IS NULL THEN 'published'
        ELSE 'failed' END AS status,
      CASE WHEN hit AND error IS NOT NULL THEN strftime(TIMESTAMP '{v.AS_OF}'
          + to_seconds(least(300, CAST(power(2, least(attempt_count, 8)) AS INTEGER))),
          '%Y-%m-%d %H:%M:%S.%f') ELSE {v.text_sql('available_at')} END AS available_at,
      CASE WHEN hit AND error IS NOT NULL THEN error ELSE '' END AS last_error,
      CASE WHEN hit THEN '' ELSE COALESCE(locked_by, '') END AS locked_by,
      hit AND error IS NULL AS is_published
    FROM (SELECT *, COALESCE(status = 'publishing' AND locked_by = '{v.WORKER}', FALSE) AS hit
          FROM v_resolved)""")
def outbox_complete(spark, sf):
    snapshot, _ = box.complete(v.outbox(spark, sf), _outcomes(spark, sf), v.AS_OF, v.WORKER)
    return snapshot.select(
        "id", "status", v.text_of("available_at").alias("available_at"),
        F.coalesce("last_error", F.lit("")).alias("last_error"),
        F.coalesce("locked_by", F.lit("")).alias("locked_by"),
        F.col("published_at").isNotNull().alias("is_published"))


@query("outbox_publish_due", f"""
    SELECT id, CASE WHEN NOT due THEN status WHEN error IS NULL THEN 'published'
        ELSE 'failed' END AS status,
      CAST(CASE WHEN due THEN attempt_count + 1 ELSE attempt_count END AS INTEGER) AS attempt_count,
      CASE WHEN due AND error IS NOT NULL THEN strftime(TIMESTAMP '{v.AS_OF}'
          + to_seconds(least(300, CAST(power(2, least(attempt_count + 1, 8)) AS INTEGER))),
          '%Y-%m-%d %H:%M:%S.%f') ELSE {v.text_sql('available_at')} END AS available_at,
      CASE WHEN due THEN COALESCE(error, '') ELSE '' END AS last_error
    FROM (SELECT *, {DUE} AS due FROM v_resolved)""")
def outbox_publish_due(spark, sf):
    _, snapshot = box.publish_due(v.outbox(spark, sf), box.registry(spark), v.AS_OF, v.WORKER)
    return snapshot.select(
        "id", "status", "attempt_count", v.text_of("available_at").alias("available_at"),
        F.coalesce("last_error", F.lit("")).alias("last_error"))


@query("outbox_not_owned", f"""
    SELECT id, error IS NULL AS succeeded FROM v_resolved
    WHERE status = 'publishing' AND locked_by IS DISTINCT FROM '{v.WORKER}'""")
def outbox_not_owned(spark, sf):
    _, strangers = box.complete(v.outbox(spark, sf), _outcomes(spark, sf), v.AS_OF, v.WORKER)
    return strangers.select("id", "succeeded")


@query("outbox_batch_report", """
    SELECT COUNT(*) AS claimed, COUNT(*) FILTER (WHERE error IS NULL) AS published,
      COUNT(*) FILTER (WHERE error IS NOT NULL) AS failed
    FROM v_resolved WHERE status = 'publishing'""")
def outbox_batch_report(spark, sf):
    return box.batch_report(_outcomes(spark, sf))


@query("outbox_stuck", f"""
    SELECT id, locked_by FROM v_outbox
    WHERE status = 'publishing' AND available_at < TIMESTAMP '{v.AS_OF}'""")
def outbox_stuck(spark, sf):
    return box.stuck(v.outbox(spark, sf), v.AS_OF).select("id", "locked_by")


@query("backoff_times", """
    SELECT event_id, CAST(least(300, CAST(power(2, least(attempt, 8)) AS INTEGER)) AS INTEGER)
      AS wait_seconds FROM v_stage_events""")
def backoff_times(spark, sf):
    return v.stage_events(spark, sf).select(
        "event_id", box.backoff_seconds("attempt").alias("wait_seconds"))


@query("contract_round_trip", """
    SELECT event_id, event_type, tenant_id, number % 2 = 1 AS is_bad,
      CASE WHEN number % 2 = 1 THEN '' ELSE 'doc-' || event_id END AS document_id
    FROM v_stage_events""")
def contract_round_trip(spark, sf):
    """Encode every event to its contract and decode it; those without a document do not fit."""
    rows = v.stage_events(spark, sf).select(
        "event_id", "event_type", F.lit("2024").alias("occurred_at"),
        F.col("event_id").alias("correlation_id"), F.lit(None).cast("string").alias("causation_id"),
        "tenant_id",
        F.when(F.col("number") % 2 == 0, F.concat(F.lit("doc-"), "event_id"))
        .alias("document_id"),
        F.lit("s3://sources/x").alias("payload_uri"),
        F.lit(schemas.SCHEMA_VERSION).alias("schema_version"))
    back = decode(encode(rows, "document-submitted").select("value"), "document-submitted")
    return back.select("event_id", "event_type", "tenant_id",
                       F.col("bad_record").isNotNull().alias("is_bad"),
                       F.coalesce("document_id", F.lit("")).alias("document_id"))


# Topic of a record by its event type; one type has a topic nobody declared.
TOPIC_OF = {
    "click": schemas.DOCUMENT_SUBMITTED,
    "view": schemas.retry_topic(schemas.FETCHER),
    "purchase": schemas.dead_letter_topic(schemas.EXTRACTOR),
    "signup": schemas.DOCUMENT_FETCHED,
    "error": "undeclared",
}


@query("retention_live_events", f"""
    SELECT event_id, topic FROM (
      SELECT event_id, occurred_at, {v.choose_sql('event_type', TOPIC_OF)} AS topic
      FROM v_stage_events)
    WHERE topic <> 'undeclared' AND occurred_at >= TIMESTAMP '2024-01-31 00:00:00'
      - to_days(CASE WHEN topic LIKE '%.retry' THEN 1 WHEN topic LIKE '%.dlq' THEN 30 ELSE 7 END)
    """)
def retention_live_events(spark, sf):
    records = v.stage_events(spark, sf).withColumn("topic", v.choose("event_type", TOPIC_OF))
    return retain(records, topic_specs(spark), "2024-01-31 00:00:00", "occurred_at") \
        .select("event_id", "topic")


_DECLARED = " UNION ALL ".join(
    [f"SELECT '{t}' AS topic, 'event' AS kind" for t in schemas.EVENT_TOPICS]
    + [f"SELECT '{schemas.retry_topic(s)}', 'retry'" for s in schemas.STAGES]
    + [f"SELECT '{schemas.dead_letter_topic(s)}', 'dead_letter'" for s in schemas.STAGES])


@query("topic_gap", f"""
    SELECT topic, kind FROM ({_DECLARED})
    WHERE topic NOT IN (SELECT {v.choose_sql('event_type', TOPIC_OF)} FROM events)""")
def topic_gap(spark, sf):
    observed = v.table(spark, sf, "events").select(v.choose("event_type", TOPIC_OF).alias("topic"))
    return missing_topics(topic_specs(spark), observed).select("topic", "kind")


@query("topic_volume", f"""
    SELECT d.topic, kind, COUNT(e.event_id) AS records
    FROM ({_DECLARED}) d LEFT JOIN events e
      ON {v.choose_sql('e.event_type', TOPIC_OF)} = d.topic GROUP BY ALL""")
def topic_volume(spark, sf):
    """Records per declared topic: counts first, then the sixteen rows meet sixteen counts."""
    counts = metrics.outcome_counts(
        v.table(spark, sf, "events").select(v.choose("event_type", TOPIC_OF).alias("topic")),
        ["topic"], "records")
    return topic_specs(spark).join(counts, "topic", "left").select(
        "topic", "kind", F.coalesce("records", F.lit(0)).alias("records"))


@query("outcome_counters", """
    SELECT stage AS worker, CASE WHEN attempt = 0 THEN 'processed' ELSE 'duplicate' END AS outcome,
      COUNT(*) AS messages FROM v_stage_events GROUP BY ALL""")
def outcome_counters(spark, sf):
    labelled = v.stage_events(spark, sf).select(
        F.col("stage").alias("worker"),
        F.when(F.col("attempt") == 0, "processed").otherwise("duplicate").alias("outcome"))
    return metrics.outcome_counts(labelled, ["worker", "outcome"])


@query("metric_windows", """
    SELECT strftime(time_bucket(INTERVAL 15 SECOND, occurred_at), '%Y-%m-%d %H:%M:%S.%f')
      AS window_start, stage, COUNT(*) AS messages FROM v_stage_events GROUP BY ALL""")
def metric_windows(spark, sf):
    return outcome_windows(v.stage_events(spark, sf), ["stage"], "occurred_at").select(
        v.text_of("window_start").alias("window_start"), "stage", "messages")


def failures(spark, sf):
    """Failures from the events: an even value band means the failure was resolved later."""
    return v.stage_events(spark, sf).select(
        F.col("event_id").alias("id"), "tenant_id",
        F.concat(F.lit("v-"), (F.col("number") % 500).cast("string"))
        .alias("document_version_id"),
        "stage", F.col("event_type").alias("error_code"),
        F.col("occurred_at").alias("first_seen_at"), F.col("occurred_at").alias("last_seen_at"),
        F.lit(1).alias("occurrence_count"),
        F.when(F.floor("value") % 2 == 0, F.col("occurred_at")).alias("resolved_at"))


@query("open_failures", f"""
    SELECT event_id AS id, tenant_id, stage, {v.text_sql('occurred_at')} AS last_seen_at
    FROM v_stage_events WHERE CAST(floor(value) AS BIGINT) % 2 <> 0""")
def open_failures(spark, sf):
    return metrics.open_failures(failures(spark, sf)).select(
        "id", "tenant_id", "stage", v.text_of("last_seen_at").alias("last_seen_at"))


@query("failure_rollup_by_stage", f"""
    SELECT tenant_id, 'v-' || (number % 500) AS document_version_id, stage,
      event_type AS error_code, {v.text_sql('MIN(occurred_at)')} AS first_seen_at,
      {v.text_sql('MAX(occurred_at)')} AS last_seen_at, COUNT(*) AS occurrence_count
    FROM v_stage_events GROUP BY tenant_id, number % 500, stage, event_type""")
def failure_rollup_by_stage(spark, sf):
    return metrics.failure_rollup(failures(spark, sf)) \
        .withColumn("first_seen_at", v.text_of("first_seen_at")) \
        .withColumn("last_seen_at", v.text_of("last_seen_at"))


@query("audit_timeline", f"""
    SELECT number AS id, tenant_id, event_type AS action, {v.text_sql('occurred_at')} AS occurred_at
    FROM v_stage_events""")
def audit_timeline(spark, sf):
    log = v.stage_events(spark, sf).select(
        F.col("number").alias("id"), "tenant_id", F.col("event_type").alias("action"),
        "occurred_at")
    return metrics.audit_timeline(log).select(
        "id", "tenant_id", "action", v.text_of("occurred_at").alias("occurred_at"))
