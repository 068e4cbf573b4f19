import json

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import backoff_seconds, iso_instant
from docloom.operators import outbox as box
from docloom.operators.tables import conform
from docloom.session import cut_lineage

AS_OF = "2024-05-01 12:00:00"
RECORD = {part.split()[0]: 1 if part.endswith("bigint") else "1.0.0"
          for ddl in schemas.CONTRACTS.values() for part in ddl.split(", ")}


@pytest.fixture()
def outbox(rows):
    def build(*entries):
        df = rows(
            "id string, status string, at string, made string, attempts int, ns string, "
            "schema_name string, locked_by string", *entries)
        return conform(df.select(
            "id", F.lit("t").alias("tenant_id"), F.concat(F.lit("e"), "id").alias("event_id"),
            F.lit("document").alias("aggregate_type"), F.concat(F.lit("agg"), "id")
            .alias("aggregate_id"), F.lit("X").alias("event_type"), F.lit("topic-a")
            .alias("kafka_topic"), F.col("ns").alias("event_contract_namespace"),
            F.col("schema_name").alias("event_schema_name"),
            F.lit(json.dumps(RECORD)).alias("payload"),
            F.lit('{"event_type":"X"}').alias("headers"), "status",
            F.col("attempts").alias("attempt_count"),
            F.col("at").cast("timestamp").alias("available_at"), "locked_by",
            F.col("made").cast("timestamp").alias("created_at"),
        ), schemas.TABLES["ingestion_outbox"])

    return build


def entry(id, status="pending", at="2024-05-01 10:00:00", made="2024-05-01 09:00:00", attempts=0,
          ns="rag.ingestion.v1", name="document-fetched", by=None):
    return (id, status, at, made, attempts, ns, name, by)


def test_claim_takes_the_oldest_due_rows(outbox):
    df = outbox(entry("a", at="2024-05-01 11:00:00"), entry("b", at="2024-05-01 10:00:00"),
                entry("c", "failed", at="2024-05-01 10:00:00", made="2024-05-01 08:00:00",
                      attempts=2),
                entry("d", "publishing"), entry("e", "published"),
                entry("f", at="2024-05-01 13:00:00"))
    claimed = box.claim(df, AS_OF, 2, "w").orderBy("id").collect()
    assert [(r.id, r.status, r.locked_by, r.attempt_count) for r in claimed] \
        == [("b", "publishing", "w", 1), ("c", "publishing", "w", 3)]
    after = {r.id: r.status for r in box.apply_claim(df, box.claim(df, AS_OF, 2, "w")).collect()}
    assert after == {"a": "pending", "b": "publishing", "c": "publishing", "d": "publishing",
                     "e": "published", "f": "pending"}


def test_claim_plan_is_a_top_k(outbox):
    plan = box.claim(outbox(entry("a")), AS_OF, 5, "w")._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


@pytest.mark.parametrize("size", [0, 1001])
def test_claim_bounds(outbox, size):
    with pytest.raises(ValueError):
        box.claim(outbox(entry("a")), AS_OF, size, "w")


def test_envelope_and_contract_fallbacks(spark, outbox):
    df = outbox(entry("a", ns=""), entry("b", name=""), entry("c", name="no-such"),
                entry("d", ns=None, name=None))
    got = {r.id: r for r in box.envelope(df, box.registry(spark)).collect()}
    assert got["a"].error is None and got["a"].key == "t:agga" and got["a"].topic == "topic-a"
    assert {h.key: bytes(h.value).decode() for h in got["a"].headers} == {
        "event_type": "X", "content-type": "application/json",
        "event-contract-namespace": "rag.ingestion.v1", "event-schema-name": "document-fetched",
        "schema-version": "1.0.0"}
    assert "missing" in got["b"].error and "missing" in got["d"].error
    assert got["c"].error.endswith("rag.ingestion.v1/no-such.")


def test_older_column_names_are_the_second_choice(rows):
    df = rows("event_contract_namespace string, schema_group_id string, event_schema_name string, "
              "schema_artifact_id string", ("", "old-ns", None, "old-name"), ("n", "o", "s", "t"))
    got = [(r.contract_namespace, r.schema_name) for r in box.resolve_contract(df).collect()]
    assert got == [("old-ns", "old-name"), ("n", "s")]


def test_complete_changes_only_rows_held_by_the_worker(outbox):
    df = outbox(entry("a", "publishing", by="w"), entry("b", "publishing", attempts=3, by="w"),
                entry("c", "publishing", by="other"), entry("d", "pending"))
    outcomes = df.select(
        "id", (F.col("id") != "b").alias("succeeded"),
        F.when(F.col("id") == "b", "boom").alias("error_message"),
        F.when(F.col("id") == "b", F.lit("2024-05-01 12:00:08").cast("timestamp"))
        .alias("retry_at"))
    snapshot, strangers = box.complete(df, outcomes, AS_OF, "w")
    got = {r.id: r for r in snapshot.collect()}
    assert (got["a"].status, got["a"].locked_by, got["a"].last_error) == ("published", None, None)
    assert got["a"].published_at is not None
    assert (got["b"].status, got["b"].last_error, got["b"].published_at) == ("failed", "boom", None)
    assert str(got["b"].available_at) == "2024-05-01 12:00:08"
    assert got["c"].status == "publishing" and got["c"].locked_by == "other"
    assert sorted(r.id for r in strangers.collect()) == ["c", "d"]


def test_backoff(rows):
    df = rows("n int", *[(n,) for n in range(12)])
    assert [r[0] for r in df.orderBy("n").select(backoff_seconds("n")).collect()] \
        == [min(300, 2 ** min(n, 8)) for n in range(12)]


def test_first_failure_waits_two_seconds(spark, outbox):
    claimed = box.claim(outbox(entry("a", name="")), AS_OF, 5, "w")
    outcome = box.outcomes_of(box.envelope(claimed, box.registry(spark)), AS_OF).first()
    assert not outcome.succeeded and str(outcome.retry_at) == "2024-05-01 12:00:02"


@pytest.mark.parametrize("contract", list(schemas.CONTRACTS))
def test_payload_must_fit_its_contract(spark, outbox, contract):
    fields = [p.split() for p in schemas.CONTRACTS[contract].split(", ")]
    optional = schemas.NULLABLE_FIELDS.get(contract, ())

    def error(payload):
        df = outbox(entry("a", name=contract)).withColumn("payload", F.lit(payload))
        got = box.envelope(df, box.registry(spark)).first().error
        return got and got.rsplit(": ", 1)[1].rstrip(".")

    assert error(json.dumps(RECORD)) is None and error(json.dumps({**RECORD, "more": [1]})) is None
    assert error("[1]") == error("{") == "no record"
    for name, kind in fields[4:7]:
        lacking = {k: x for k, x in RECORD.items() if k != name}
        free = None if name in optional else name
        assert error(json.dumps(lacking)) == free and error(json.dumps({**RECORD, name: None})) == free
        assert error(json.dumps({**RECORD, name: "1" if kind == "bigint" else 1})) == name


def test_polling_and_publishing_at_once_agree(spark, outbox, tmp_path):
    names = ["document-fetched", "", "no-such", "content-extracted"]
    df = cut_lineage(outbox(*[
        entry(f"{i:02}", ["pending", "failed", "published"][i % 3], attempts=i % 5,
              at=f"2024-05-01 {9 + i % 5:02}:00:00", name=names[i % 4]) for i in range(30)]))
    polled, sent = df, []
    while (claimed := box.claim(polled, AS_OF, 4, "w")).count():
        enveloped = box.envelope(claimed, box.registry(spark))
        sent += [r.key for r in enveloped.filter("error IS NULL").collect()]
        polled = cut_lineage(box.complete(
            box.apply_claim(polled, claimed), box.outcomes_of(enveloped, AS_OF), AS_OF, "w")[0])
    messages, snapshot = box.publish_due(df, box.registry(spark), AS_OF, "w")
    assert sorted(map(str, polled.collect())) == sorted(map(str, snapshot.collect()))
    assert sorted(sent) == sorted(r.key for r in messages.collect())


def test_report_and_stuck(spark, outbox):
    df = outbox(entry("a"), entry("b", name=""), entry("c"))
    report = box.batch_report(box.outcomes_of(box.envelope(df, box.registry(spark)), AS_OF)).first()
    assert (report.claimed, report.published, report.failed) == (3, 2, 1)
    held = box.claim(df, "2024-05-01 11:00:00", 2, "w")
    assert box.stuck(held, AS_OF).count() == 2 and box.stuck(held, "2024-05-01 10:30:00").count() == 0


def test_iso_instant(spark):
    got = spark.sql("SELECT timestamp'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.6' b") \
        .select(iso_instant("a"), iso_instant("b")).first()
    assert got[0] == "2024-01-02T03:04:05+00:00" and got[1] == "2024-01-02T03:04:05.600000+00:00"


def test_payload_is_json(outbox):
    assert json.loads(outbox(entry("a")).first().payload)["schema_version"] == "1.0.0"
