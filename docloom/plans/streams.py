"""Streaming jobs over the given tables, run until their input is used up.

Each reads a table or a log derived from one as a file stream, writes below the shared folder and
returns what it wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import outbox as box
from docloom.plans import content, ingest  # noqa: F401 (their SQL twins are reused)
from docloom.plans import views as v
from docloom.plans.delivery import DUE
from docloom.plans.registry import ORACLES, query
from docloom.session import scratch
from docloom.sources.event_log import encode, stream_log, write_log
from docloom.sources.snapshots import TableStore
from docloom.streaming import flows, stages, timers


def _log(events, contract: str, topic: str, path: str) -> None:
    write_log(encode(events, contract).select(
        F.lit(topic).alias("topic"),
        F.concat_ws(":", "tenant_id", "document_id").alias("key"), "value",
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers")), path)


def _store(spark, sf, root: str) -> TableStore:
    store = TableStore(spark, root)
    store.put_base("document_versions", v.stored_versions(spark, sf))
    store.put_base("documents", v.stored_documents(spark, sf))
    return store


def _clock():
    return v.AS_OF


@query("stream_fetch", ORACLES["fetch_document_status"])
def stream_fetch(spark, sf):
    """The fetch stage from the submitted topic; the tables end as the batch form leaves them."""
    root = scratch(spark, "stream-fetch")
    events = v.submitted(spark, sf) \
        .withColumn("occurred_at", F.lit("2024-01-16T00:00:00+00:00")) \
        .withColumn("causation_id", F.lit(None).cast("string")) \
        .withColumn("schema_version", F.lit(schemas.SCHEMA_VERSION))
    _log(events, "document-submitted", schemas.DOCUMENT_SUBMITTED, f"{root}/log")
    store = _store(spark, sf, f"{root}/tables")
    store.put_base("processed_events", v.ledger(spark, sf))
    stages.start_fetch(
        stream_log(spark, f"{root}/log", schemas.DOCUMENT_SUBMITTED), v.objects(spark, sf), store, f"{root}/checkpoint",
        bucket=v.BUCKET, clock=_clock, max_bytes=v.LIMIT).awaitTermination()
    return store.current("documents").select("id", "status")


@query("stream_extract", ORACLES["extract_document_status"])
def stream_extract(spark, sf):
    """The extract stage from the fetched topic, with its artifacts."""
    root = scratch(spark, "stream-extract")
    events = content.fetched_events(spark, sf) \
        .withColumn("occurred_at", F.lit("2024-01-16T00:00:00+00:00")) \
        .withColumn("causation_id", F.lit("none")) \
        .withColumn("byte_size", F.lit(1).cast("bigint")) \
        .withColumn("inspection_metadata", F.lit("{}")) \
        .withColumn("schema_version", F.lit(schemas.SCHEMA_VERSION))
    _log(events, "document-fetched", schemas.DOCUMENT_FETCHED, f"{root}/log")
    store = _store(spark, sf, f"{root}/tables")
    stages.start_extract(
        stream_log(spark, f"{root}/log", schemas.DOCUMENT_FETCHED), v.objects(spark, sf), store, f"{root}/artifacts",
        f"{root}/checkpoint", factory=content.text_converter, bucket=v.BUCKET,
        artifact_bucket=v.ARTIFACTS, clock=_clock, extractor=content.EXTRACTOR,
        extractor_version=content.EXTRACTOR_VERSION, max_bytes=content.EXTRACT_LIMIT,
    ).awaitTermination()
    return store.current("documents").select("id", "status")


@query("stream_dedup", "SELECT event_id, user_id FROM events")
def stream_dedup(spark, sf):
    """Every event is delivered twice and kept once."""
    root = scratch(spark, "stream-dedup")
    twice = v.table_stream(spark, sf, "events") \
        .withColumn("occurred_at", F.col("ts").cast("timestamp")) \
        .select("event_id", "user_id", "occurred_at", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = flows.dedup_within(twice, ["event_id"], "occurred_at", "1 hour")
    flows.to_table(kept.select("event_id", "user_id"), f"{root}/out", f"{root}/checkpoint") \
        .awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint").parquet(f"{root}/out")


BATCHES = 3


def _event_files(spark, sf, path: str):
    """The events as a stream of ``BATCHES`` micro-batches, dealt by id, so that time starts over in
    each and rows of the later ones come late."""
    events = v.stage_events(spark, sf).select("event_id", "number", "event_type", "occurred_at")
    for batch in range(BATCHES):
        events.filter(F.col("number") % BATCHES == batch).repartition(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


# Milliseconds of each event, and of the watermark its micro-batch meets: that of the batches before.
_MARKED = f"""
    SELECT *, epoch_us(occurred_at) // 1000 AS at_ms, coalesce((SELECT max(epoch_us(o.occurred_at)) // 1000 FROM v_stage_events o
      WHERE o.number % {BATCHES} < e.number % {BATCHES}) - {{lateness}}, 0) AS mark FROM v_stage_events e"""


@query("stream_dedup_outcomes", f"""
    WITH marked AS ({_MARKED.format(lateness="(SELECT (max(epoch_us(ts)) // 1000 - min(epoch_us(ts)) // 1000) // 2 FROM events)")})
    SELECT event_id, unnest(CASE WHEN at_ms < mark THEN ['late'] ELSE ['accepted', 'duplicate'] END) AS outcome,
      CASE WHEN at_ms < mark THEN 2 ELSE 1 END AS deliveries FROM marked""")
def stream_dedup_outcomes(spark, sf):
    """Every event is delivered twice, over several micro-batches: each delivery is accepted, a
    duplicate or late. The watermark trails by half the time the events span."""
    root = scratch(spark, "stream-outcomes")
    stream = _event_files(spark, sf, f"{root}/in")
    low, high = v.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts")) \
        .agg(F.unix_millis(F.min("ts")), F.unix_millis(F.max("ts"))).first()
    twice = stream.select("event_id", "occurred_at", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    judged = timers.deduplicated(twice.drop("copy"), ["event_id"], "occurred_at", f"{(high - low) // 2} milliseconds",
                                 (high - low) // 1000 + 1)
    flows.to_table(judged, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("event_id string, outcome string").parquet(f"{root}/out") \
        .groupBy("event_id", "outcome").agg(F.count(F.lit(1)).cast("int").alias("deliveries"))


@query("stream_window_outcomes", f"""
    WITH marked AS ({_MARKED.format(lateness="60000")}),
    placed AS (SELECT event_type, at_ms // 15000 * 15000 AS start_ms, at_ms // 15000 * 15000 + 15000 <= mark AS late FROM marked),
    last AS (SELECT max(epoch_us(ts)) // 1000 - 60000 AS mark FROM events)
    SELECT strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type,
      CAST(COUNT(*) FILTER (WHERE NOT late) AS BIGINT) AS messages, CAST(COUNT(*) FILTER (WHERE late) AS BIGINT) AS late
    FROM placed, last WHERE start_ms + 15000 <= last.mark GROUP BY 1, 2""")
def stream_window_outcomes(spark, sf):
    """Windows that have closed, with the rows that came too late for them."""
    root = scratch(spark, "stream-window-outcomes")
    counted = timers.counted_windows(_event_files(spark, sf, f"{root}/in"), ["event_type"], "occurred_at")
    flows.to_table(counted, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("window_start timestamp, event_type string, messages bigint, late bigint") \
        .parquet(f"{root}/out").groupBy(v.text_of("window_start").alias("window_start"), "event_type") \
        .agg(F.sum("messages").alias("messages"), F.sum("late").alias("late"))


@query("stream_publish_tries", """
    SELECT id, CASE WHEN error IS NULL THEN 'published' ELSE 'failed' END AS status,
      CAST(attempt_count + 1 AS INTEGER) AS attempt_count, coalesce(left(error, 4000), '') AS last_error
    FROM v_resolved WHERE status IN ('pending', 'failed')""")
def stream_publish_tries(spark, sf):
    """The outbox as a stream with delayed retries: the first try of every row that is not held."""
    root = scratch(spark, "stream-publish")
    rows = v.outbox(spark, sf)
    rows.write.parquet(f"{root}/in")
    checked = box.with_publish_error(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), box.registry(spark))
    flows.to_table(timers.publishing(checked, "created_at"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    first = F.min_by(F.struct("status", "attempt_count", F.coalesce("last_error", F.lit("")).alias("last_error")), "attempt_count")
    return spark.read.schema(timers.RETRIED).parquet(f"{root}/out").groupBy("id").agg(first.alias("x")).select("id", "x.*")


@query("stream_retry", f"""
    SELECT event_id, CASE WHEN value < 20 THEN '{schemas.CONTENT_EXTRACTED}'
      WHEN event_type <> 'error' AND event_id % 10 < 5
        THEN '{schemas.retry_topic(schemas.EXTRACTOR)}'
      ELSE '{schemas.dead_letter_topic(schemas.EXTRACTOR)}' END AS topic
    FROM events""")
def stream_retry(spark, sf):
    """Outcomes routed to the next, the retry or the dead-letter topic, one folder each."""
    root = scratch(spark, "stream-retry")
    routed = flows.routed(
        v.table_stream(spark, sf, "events"), accepted=F.col("value") < 20,
        attempts=F.col("event_id") % 10, transient=F.col("event_type") != "error",
        stage=schemas.EXTRACTOR, next_topic=schemas.CONTENT_EXTRACTED, max_attempts=5)
    flows.to_table(routed.select("event_id", "topic"), f"{root}/out", f"{root}/checkpoint",
                   ["topic"]).awaitTermination()
    return spark.read.schema("event_id bigint, topic string").parquet(f"{root}/out")


@query("stream_windows", """
    SELECT strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type, messages
    FROM (SELECT time_bucket(INTERVAL 15 SECOND, ts) AS start, event_type, COUNT(*) AS messages
          FROM events GROUP BY ALL)
    WHERE start + INTERVAL 15 SECOND
      <= (SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 1 MINUTE FROM events)""")
def stream_windows(spark, sf):
    """Windows the watermark has closed."""
    root = scratch(spark, "stream-windows")
    stream = v.table_stream(spark, sf, "events") \
        .withColumn("occurred_at", F.col("ts").cast("timestamp"))
    counts = flows.outcome_windows(stream, ["event_type"], "occurred_at")
    flows.to_table(counts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(
        "window_start timestamp, window_end timestamp, event_type string, messages bigint"
    ).parquet(f"{root}/out").select(
        v.text_of("window_start").alias("window_start"), "event_type", "messages")


@query("publish_to_log", f"""
    SELECT id AS event_id, kafka_topic AS topic, tenant_id || ':' || aggregate_id AS key
    FROM v_resolved WHERE {DUE} AND error IS NULL""")
def publish_to_log(spark, sf):
    """Publish everything due to the log and read the log back."""
    path = scratch(spark, "publish")
    messages, _ = box.publish_due(v.outbox(spark, sf), box.registry(spark), v.AS_OF, v.WORKER)
    write_log(messages.withColumn(
        "headers", F.concat("headers", F.array(F.struct(
            F.lit("id").alias("key"), F.col("id").cast("binary").alias("value"))))), path)
    stored = spark.read.schema(
        "key string, value string, headers array<struct<key:string,value:binary>>, topic string"
    ).parquet(path)
    own = F.element_at(F.filter("headers", lambda h: h["key"] == "id"), 1)
    return stored.select(own["value"].cast("string").alias("event_id"), "topic", "key")
