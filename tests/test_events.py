import json

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import events as ev
from docloom.sources import event_log as log


def test_contract_fields():
    head = ["event_id", "event_type", "occurred_at", "correlation_id", "causation_id", "tenant_id",
            "document_id"]
    for ddl in schemas.CONTRACTS.values():
        names = schemas.field_names(ddl)
        assert names[:7] == head and names[-1] == "schema_version"
        # References only: no bytes and no text travel in an event.
        assert not {"content", "text", "markdown"} & set(names)


def test_submitted_event_correlates_with_itself_unless_given(rows):
    df = rows("tenant_id string, document_id string, document_version_id string, "
              "payload_uri string, correlation_id string", ("t", "d", "v", "s3://b/k", None),
              ("t", "d2", "v2", "s3://b/k", "given"))
    own, given = ev.submitted_events(df, "2024-01-01").orderBy("document_id").collect()
    assert own.correlation_id == own.event_id and given.correlation_id == "given"
    assert own.causation_id is None and own.occurred_at == "2024-01-01T00:00:00+00:00"
    assert len(own.event_id) == 36


@pytest.mark.parametrize("contract", list(schemas.CONTRACTS))
def test_round_trip(spark, contract):
    names = schemas.field_names(schemas.CONTRACTS[contract])
    df = spark.range(1).select(*[
        (F.lit(7).cast("bigint") if n == "byte_size" else F.lit(f"x-{n}")).alias(n) for n in names])
    encoded = log.encode(df, contract)
    assert list(json.loads(encoded.first().value)) == names
    back = log.decode(encoded.select("value"), contract)
    assert back.first().asDict() == {**df.first().asDict(), "bad_record": None}


def test_records_that_do_not_fit(rows):
    good = dict.fromkeys(schemas.field_names(schemas.CONTRACTS["document-submitted"]), "x")
    cases = [good, {**good, "causation_id": None}, {**good, "tenant_id": None},
             {k: x for k, x in good.items() if k != "schema_version"}]
    df = rows("value string", *[(json.dumps(c),) for c in cases], ("not json",))
    got = log.decode(df, "document-submitted").collect()
    assert [r.bad_record is None for r in got] == [True, True, False, True, False]
    assert got[3].schema_version == "1.0.0"


def test_avro_declaration():
    record = json.loads(log.avro_schema("document-submitted"))
    types = {f["name"]: f["type"] for f in record["fields"]}
    assert record["name"] == "DocumentSubmitted" and types["causation_id"] == ["null", "string"]
    size = json.loads(log.avro_schema("document-fetched"))["fields"]
    assert {"name": "byte_size", "type": "long"} in size


def test_topics(spark, rows):
    specs = {r.topic: r.retention_ms for r in log.topic_specs(spark).collect()}
    assert len(specs) == 16
    assert specs[schemas.DOCUMENT_SUBMITTED] == 7 * schemas.DAY_MS
    assert specs[schemas.retry_topic("chunker")] == schemas.DAY_MS
    assert specs[schemas.dead_letter_topic("indexer")] == 30 * schemas.DAY_MS
    seen = rows("topic string", (schemas.DOCUMENT_SUBMITTED,), ("foreign",))
    assert log.missing_topics(log.topic_specs(spark), seen).count() == 15


def test_retention_edges(spark, rows):
    df = rows("topic string, ts string", (schemas.DOCUMENT_SUBMITTED, "2024-01-01 00:00:00"),
              (schemas.DOCUMENT_SUBMITTED, "2023-12-31 23:59:59.999"),
              (schemas.retry_topic("chunker"), "2024-01-06 23:59:59"), ("undeclared", "2024-01-08"))
    kept = log.retain(df.withColumn("ts", F.col("ts").cast("timestamp")), log.topic_specs(spark),
                      "2024-01-08 00:00:00")
    assert [(r.topic, str(r.ts)) for r in kept.collect()] \
        == [(schemas.DOCUMENT_SUBMITTED, "2024-01-01 00:00:00")]


def test_routing(rows):
    df = rows("ok boolean, attempts int, transient boolean", (True, 9, False), (False, 0, True),
              (False, 3, True), (False, 0, False))
    topic = ev.topic_for(F.col("ok"), F.col("attempts"), F.col("transient"), "chunker", "next", 3)
    assert [r[0] for r in df.select(topic).collect()] == [
        "next", schemas.retry_topic("chunker"), schemas.dead_letter_topic("chunker"),
        schemas.dead_letter_topic("chunker")]
    expected, others = ev.route(rows("event_type string", ("A",), ("B",), (None,)), "A")
    assert expected.count() == 1 and others.count() == 2
