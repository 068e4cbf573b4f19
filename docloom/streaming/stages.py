"""The fetch and extract stages as streams over the event log.

Delivery is at least once; the effect is once. A batch reads the tables without its own earlier
try, writes every output to a folder of its own and the ledger last, and takes all ids from the
parent events, so running it again leaves the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom import schemas
from docloom.operators.extraction import Converter, extract_stage
from docloom.operators.fetching import Inspector, StageResult, fetch_stage
from docloom.operators.outbox import publish_due, registry
from docloom.operators.tables import conform
from docloom.session import cut_lineage
from docloom.sources.event_log import BAD_RECORD, decode
from docloom.sources.objects import write_artifacts
from docloom.sources.snapshots import Batch, TableStore


def _arrivals(batch: DataFrame, contract: str) -> DataFrame:
    """Decoded events with their place in the source; records that do not fit the contract are left aside."""
    return decode(batch.withColumnRenamed("position", "event_offset"), contract)


def _seen(store: TableStore, events: DataFrame, skip: Batch) -> DataFrame:
    """Ledger rows of this batch's events. The ledger grows for ever and the batch does not: the
    semi join lets Spark broadcast the batch's keys after measuring them, and the ledger is
    scanned where it lies."""
    keys = ["tenant_id", "event_id"]
    return store.added("processed_events", skip) \
        .join(events.select(*keys).distinct(), keys, "left_semi")


def _touched(store: TableStore, events: DataFrame, skip: Batch) -> DataFrame:
    """Versions of the documents this batch is about."""
    return store.current("document_versions", skip,
                         events.select("tenant_id", "document_id").distinct())


def _write(store: TableStore, result: StageResult, bad: DataFrame, batch: Batch, as_of) -> None:
    def changes(df: DataFrame, table: str) -> DataFrame:
        return conform(df, schemas.STORED[table]) \
            .withColumn("applied_at", F.lit(as_of).cast("timestamp")) \
            .withColumn("event_offset", F.lit(batch.number).cast("bigint"))

    store.put("document_versions", "changed",
              changes(result.version_changes, "document_versions"), batch)
    store.put("documents", "changed", changes(result.document_changes, "documents"), batch)
    if result.failures is not None:
        store.put("ingestion_failures", "added", result.failures, batch)
    store.put("ingestion_outbox", "added", result.outbox, batch)
    store.put("quarantine", "added", result.quarantine, batch)
    store.put("bad_records", "added", bad.select(BAD_RECORD), batch)
    store.put("processed_events", "added", result.ledger, batch)


def _run_of(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


DRAIN = {"availableNow": True}  # all that is there, then stop; {"processingTime": "5 seconds"} runs on


def _start(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str,
           name: str, trigger: Mapping) -> StreamingQuery:
    return stream.writeStream.queryName(name).foreachBatch(run) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_fetch(
    source: DataFrame,
    objects: DataFrame,
    store: TableStore,
    checkpoint: str,
    *,
    bucket: str,
    clock: Callable[[], object],
    max_bytes: int = schemas.FETCH_LIMIT_BYTES,
    signature: str = schemas.PDF_SIGNATURE,
    permitted_mime: tuple[str, ...] = schemas.PERMITTED_MIME,
    factory: Callable[[], Inspector] | None = None,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Fetch what ``source`` delivers: a stream of ``event_log.stream_log`` or ``stream_kafka``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        as_of = clock()
        decoded = cut_lineage(_arrivals(batch, "document-submitted"))
        events = decoded.filter(F.col(BAD_RECORD).isNull())
        here = Batch(schemas.FETCHER, _run_of(checkpoint), batch_id)
        wanted = events.select(F.col("payload_uri").alias("object_uri")).distinct()
        result = fetch_stage(
            events, objects.join(wanted, "object_uri", "left_semi"),
            _touched(store, events, here), store.base("documents"),
            _seen(store, events, here), bucket=bucket, as_of=as_of, signature=signature,
            max_bytes=max_bytes, permitted_mime=permitted_mime, factory=factory,
            store=cut_lineage)
        _write(store, result, decoded.filter(F.col(BAD_RECORD).isNotNull()), here, as_of)

    return _start(source, run, checkpoint, schemas.FETCHER, trigger)


def start_extract(
    source: DataFrame,
    objects: DataFrame,
    store: TableStore,
    artifact_path: str,
    checkpoint: str,
    *,
    factory: Callable[[], Converter],
    bucket: str,
    artifact_bucket: str,
    clock: Callable[[], object],
    extractor: str,
    extractor_version: str,
    max_bytes: int = schemas.EXTRACT_LIMIT_BYTES,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Extract what ``source`` delivers, with the artifacts stored below ``artifact_path``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        as_of = clock()
        decoded = cut_lineage(_arrivals(batch, "document-fetched"))
        events = decoded.filter(F.col(BAD_RECORD).isNull())
        here = Batch(schemas.EXTRACTOR, _run_of(checkpoint), batch_id)
        done = extract_stage(
            events, objects, _touched(store, events, here), store.base("documents"),
            _seen(store, events, here), factory=factory, bucket=bucket,
            artifact_bucket=artifact_bucket, as_of=as_of, extractor=extractor,
            extractor_version=extractor_version, max_bytes=max_bytes, store=cut_lineage)
        write_artifacts(done.artifacts, artifact_path, here.path)
        _write(store, done.stage, decoded.filter(F.col(BAD_RECORD).isNotNull()), here, as_of)

    return _start(source, run, checkpoint, schemas.EXTRACTOR, trigger)


PUBLISHER = "publisher"


def publish_stored(
    store: TableStore, send: Callable[[DataFrame], None], run: str, number: int, *, as_of, worker: str,
) -> None:
    """Send every outbox row of the store that is due at ``as_of`` and store its new state.

    ``send`` writes (topic, key, value, headers) to a log or a broker. It comes first: a poll that is
    cut off sends again when it is run again under its number, and the stages take an event once.
    The error text of an earlier try stays with a row that was published later.
    """
    here = Batch(PUBLISHER, run, number)
    outbox = cut_lineage(store.current("ingestion_outbox", here))
    messages, snapshot = publish_due(outbox, registry(store.spark), as_of, worker)
    send(messages)
    tried = snapshot.join(outbox.select("id", F.col("attempt_count").alias("_before")), "id") \
        .filter("attempt_count > _before").drop("_before")
    store.put("ingestion_outbox", "changed", tried
              .withColumn("updated_at", F.lit(as_of).cast("timestamp"))
              .withColumn("applied_at", F.lit(as_of).cast("timestamp"))
              .withColumn("event_offset", F.lit(number).cast("bigint")), here)
