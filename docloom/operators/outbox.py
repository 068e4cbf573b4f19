"""Outbox: claim, resolve contracts, envelope, complete with retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import backoff_seconds, plus_seconds, present
from docloom.sources.event_log import avro_payload, misfit

# The content type of a record by its encoding.
CONTENT_TYPES = {"json": "application/json", "avro": "application/vnd.apache.avro.binary"}


def _instant(as_of) -> Column:
    return F.lit(as_of).cast("timestamp")


def claimable(outbox: DataFrame, as_of) -> DataFrame:
    return outbox.filter(
        F.col("status").isin("pending", "failed") & (F.col("available_at") <= _instant(as_of)))


def claim(outbox: DataFrame, as_of, batch_size: int, worker: str) -> DataFrame:
    """The oldest due rows, marked as being published by ``worker``.

    A distributed top-k: every partition offers its first ``batch_size`` rows. The id breaks ties.
    """
    if not 1 <= batch_size <= schemas.CLAIM_BATCH_MAX:
        raise ValueError(f"batch_size must be in the range 1..{schemas.CLAIM_BATCH_MAX}")
    chosen = claimable(outbox, as_of).orderBy("available_at", "created_at", "id").limit(batch_size)
    return chosen \
        .withColumn("status", F.lit("publishing")) \
        .withColumn("locked_at", _instant(as_of)) \
        .withColumn("locked_by", F.lit(worker)) \
        .withColumn("attempt_count", F.col("attempt_count") + 1)


def apply_claim(outbox: DataFrame, claimed: DataFrame) -> DataFrame:
    """Outbox snapshot with the claimed rows replaced."""
    rest = outbox.join(claimed.select("id"), "id", "left_anti")
    return rest.unionByName(claimed)


def registry(spark) -> DataFrame:
    """The known contracts, one row each."""
    rows = [(schemas.EVENT_NAMESPACE, name) for name in schemas.CONTRACTS]
    return spark.createDataFrame(rows, "contract_namespace string, schema_name string")


def resolve_contract(events: DataFrame) -> DataFrame:
    """Add ``contract_namespace`` and ``schema_name``; older column names are the second choice
    and an empty value counts as missing."""
    def pick(*names: str) -> list[Column]:
        return [present(n) for n in names if n in events.columns]

    return events \
        .withColumn("contract_namespace", F.coalesce(
            *pick("event_contract_namespace", "schema_group_id"),
            F.lit(schemas.EVENT_NAMESPACE))) \
        .withColumn("schema_name", F.coalesce(
            *pick("event_schema_name", "schema_artifact_id"), F.lit(None).cast("string")))


def with_publish_error(events: DataFrame, contracts: DataFrame, tried: Column | None = None) -> DataFrame:
    """Resolved contract names and the error that keeps a row back, if any: a contract that is
    not named or not known, or a payload that does not fit it. Where ``tried`` is given, only the
    payloads of its rows are read, and the others have no error."""
    known = contracts.withColumn("is_known", F.lit(True))
    resolved = resolve_contract(events).join(known, ["contract_namespace", "schema_name"], "left")
    due = F.lit(True) if tried is None else tried
    field = F.when(due & F.col("is_known"), misfit("payload", "schema_name"))
    error = F.when(
        F.col("schema_name").isNull(),
        F.lit("Outbox event is missing its checked-in event schema name."),
    ).when(
        F.col("is_known").isNull(),
        F.concat(F.lit("No checked-in schema is configured for "), F.col("contract_namespace"),
                 F.lit("/"), F.col("schema_name"), F.lit(".")),
    ).when(
        field.isNotNull(),
        F.concat(F.lit("Payload does not fit "), F.col("contract_namespace"), F.lit("/"),
                 F.col("schema_name"), F.lit(": "), field, F.lit(".")),
    )
    return resolved.withColumn("error", F.when(due, error)).drop("is_known")


def envelope(claimed: DataFrame, contracts: DataFrame, encoding: str = "json") -> DataFrame:
    """Topic, key, value and headers of each claimed row, or the error that keeps it back. The
    record key is tenant and aggregate id; ``encoding`` is "json" or "avro" (with its module)."""
    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))

    own = F.coalesce(F.from_json("headers", "map<string,string>"),
                     F.create_map().cast("map<string,string>"))
    carried = F.transform(
        F.map_entries(own),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    fixed = F.array(
        header("content-type", F.lit(CONTENT_TYPES[encoding])),
        header("event-contract-namespace", F.col("contract_namespace")),
        header("event-schema-name", F.col("schema_name")),
        header("schema-version", F.get_json_object("payload", "$.schema_version")),
    )
    value = F.col("payload") if encoding == "json" else \
        F.when(F.col("error").isNull(), avro_payload("payload", "schema_name"))
    return with_publish_error(claimed, contracts).select(
        "id", "tenant_id", "attempt_count",
        F.col("kafka_topic").alias("topic"),
        F.concat_ws(":", "tenant_id", "aggregate_id").alias("key"),
        value.alias("value"),
        F.concat(carried, fixed).alias("headers"),
        "contract_namespace", "schema_name", "error",
    )


def outcomes_of(enveloped: DataFrame, as_of) -> DataFrame:
    """Publish outcomes: failures carry their cut error text and the time of the next try."""
    retry = plus_seconds(_instant(as_of), backoff_seconds("attempt_count"))
    return enveloped.select(
        "id",
        F.col("error").isNull().alias("succeeded"),
        F.substring("error", 1, schemas.ERROR_TEXT_MAX).alias("error_message"),
        F.when(F.col("error").isNotNull(), retry).alias("retry_at"),
    )


def complete(
    outbox: DataFrame, outcomes: DataFrame, as_of, worker: str
) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, outcomes that match no row claimed by ``worker``)."""
    owned = (F.col("status") == "publishing") & (F.col("locked_by") == worker)
    joined = outbox.join(outcomes, "id", "left")
    hit = F.coalesce(F.col("succeeded").isNotNull() & owned, F.lit(False))
    good = F.col("succeeded")
    changed = {
        "status": F.when(good, "published").otherwise("failed"),
        "published_at": F.when(good, _instant(as_of)),
        "available_at": F.coalesce("retry_at", "available_at"),
        "last_error": F.when(~good, F.col("error_message")),
        "locked_at": F.lit(None).cast("timestamp"),
        "locked_by": F.lit(None).cast("string"),
    }
    snapshot = joined.select(*[
        F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in outbox.columns
    ])
    held = outbox.filter(owned).select("id")
    return snapshot, outcomes.join(held, "id", "left_anti")


def stuck(outbox: DataFrame, locked_before) -> DataFrame:
    """Rows left in ``publishing``: a claim takes only pending and failed ones, so these stay."""
    return outbox.filter((F.col("status") == "publishing")
                         & (F.col("locked_at") < F.lit(locked_before).cast("timestamp")))


def batch_report(outcomes: DataFrame) -> DataFrame:
    """Counts of one poll."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("claimed"),
        F.count_if(F.col("succeeded")).alias("published"),
        F.count_if(~F.col("succeeded")).alias("failed"),
    )


def publish_due(
    outbox: DataFrame, contracts: DataFrame, as_of, worker: str
) -> tuple[DataFrame, DataFrame]:
    """Everything due at ``as_of`` in one pass: (messages to send, new outbox snapshot).

    The same end state as polling at that instant until nothing is due. The batch size bounds one
    poll of a row store; here each row's outcome follows from the row itself, so nothing is
    sorted, joined to the outbox or looped over.
    """
    due = F.col("status").isin("pending", "failed") & (F.col("available_at") <= _instant(as_of))
    tried = F.col("attempt_count") + 1
    messages = envelope(outbox.filter(due).withColumn("attempt_count", tried), contracts) \
        .filter("error IS NULL")
    sent, failed = due & F.col("error").isNull(), due & F.col("error").isNotNull()
    retry = plus_seconds(_instant(as_of), backoff_seconds(tried))
    changed = {
        "status": F.when(sent, "published").when(failed, "failed"),
        "attempt_count": F.when(due, tried),
        "published_at": F.when(sent, _instant(as_of)),
        "available_at": F.when(failed, retry),
        "last_error": F.when(failed, F.substring("error", 1, schemas.ERROR_TEXT_MAX)),
    }
    cleared = ("published_at", "last_error", "locked_at", "locked_by")

    def column(name: str) -> Column:
        if name in cleared:
            value = changed.get(name, F.lit(None).cast(outbox.schema[name].dataType))
            return F.when(due, value).otherwise(F.col(name)).alias(name)
        if name in changed:
            return F.coalesce(changed[name], F.col(name)).alias(name)
        return F.col(name)

    snapshot = with_publish_error(outbox, contracts, due).select(*[column(c) for c in outbox.columns])
    return messages, snapshot
