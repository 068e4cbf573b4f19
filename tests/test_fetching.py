import json

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import fetching as fetch
from docloom.operators import submission as sub
from docloom.session import cut_lineage
from tests.test_submission import AS_OF, DDL, row

LIMIT = 40
EVENT_DDL = ("tenant_id string, document_id string, event_id string, event_type string, "
             "correlation_id string, payload_uri string, event_offset bigint")


def uri(seq, tenant="t"):
    return f"s3://src/{tenant}/d{seq}/original/a.pdf"


@pytest.fixture()
def world(spark, rows):
    """Submitted versions, and a function that runs the stage over objects and events."""
    def build(contents, mimes=None, stored=None):
        mimes, stored = mimes or {}, stored or {}
        data = [row(i, content=c, ext=f"e{i}", mime=mimes.get(i, "application/pdf"))
                for i, c in contents.items()]
        made = sub.submit(
            rows(DDL, *data), rows("id string", ("t",)),
            spark.createDataFrame([], schemas.TABLES["documents"]),
            spark.createDataFrame([], schemas.TABLES["document_versions"]),
            bucket="src", as_of=AS_OF)
        made = made._replace(documents=cut_lineage(made.documents),
                             versions=cut_lineage(made.versions))
        objects = rows("object_uri string, content string", *[
            (uri(i), stored.get(i, c)) for i, c in contents.items()
            if stored.get(i, c) is not None])

        def run(*events, ledger=None, versions=None, **kw):
            return fetch.fetch_stage(
                rows(EVENT_DDL, *events), objects, versions or made.versions, made.documents,
                ledger or spark.createDataFrame([], schemas.TABLES["processed_events"]),
                bucket="src", as_of=AS_OF, max_bytes=LIMIT, store=cut_lineage, **kw)

        return made, run

    return build


def event(seq, offset=None, kind="DocumentSubmitted", at=None, name=None):
    return ("t", f"d{seq}", name or f"ev{seq}", kind, f"c{seq}", at or uri(seq),
            seq if offset is None else offset)


def codes(result):
    got = {}
    for r in result.outbox.collect():
        p = json.loads(r.payload)
        meta = json.loads(p["inspection_metadata"])
        got[p["document_id"]] = meta.get("validation_error", "valid")
    return got


GOOD = "%PDF-1.7 body"


def test_every_code(world):
    long = "%PDF-" + "x" * LIMIT
    _, run = world(
        {1: GOOD, 2: "<html>", 3: long, 4: GOOD + "4", 5: GOOD + "5", 6: GOOD + "6"},
        mimes={5: "text/html"}, stored={4: GOOD + "changed"})
    result = run(event(1), event(2), event(3), event(4), event(5),
                 event(6, kind="DocumentTouched"), event(7, at=uri(1)))
    assert codes(result) == {
        "d1": "valid", "d2": "invalid_pdf_signature", "d3": "document_too_large",
        "d4": "source_checksum_mismatch", "d5": "declared_mime_type_mismatch",
        "d6": "unexpected_event_type", "d7": "unknown_source_object"}


def test_precedence_of_neighbouring_codes(world):
    long_html = "<html>" + "x" * LIMIT
    long = "%PDF-" + "x" * LIMIT
    _, run = world(
        {1: GOOD, 2: long_html, 3: GOOD + "3", 4: GOOD + "4", 5: GOOD + "5"},
        mimes={3: "text/html", 4: "text/html"},
        stored={3: long, 4: GOOD + "changed"})
    result = run(
        event(9, kind="DocumentTouched", at=uri(1)),  # unknown version before stray type
        event(2),                                     # signature before size
        event(3),                                     # size before checksum and declared type
        event(4),                                     # checksum before declared type
        event(5, kind="DocumentTouched", at=uri(5)))
    assert codes(result) == {
        "d9": "unknown_source_object", "d2": "invalid_pdf_signature", "d3": "document_too_large",
        "d4": "source_checksum_mismatch", "d5": "unexpected_event_type"}


def test_writes_of_valid_and_refused_events(world):
    made, run = world({1: GOOD, 2: "%PDF-" + "x" * LIMIT})
    result = run(event(1), event(2))
    versions = {r.document_id: r for r in result.versions.collect()}
    assert versions["d1"].inspection_status == "valid"
    assert versions["d1"].detected_mime_type == "application/pdf"
    assert json.loads(versions["d1"].inspection_metadata) == {
        "declared_mime_type": "application/pdf", "detected_mime_type": "application/pdf",
        "format": "pdf", "is_encrypted": False, "max_document_bytes": LIMIT}
    assert versions["d2"].inspection_status == "invalid"
    assert json.loads(versions["d2"].inspection_metadata) == {
        "validation_error": "document_too_large",
        "message": fetch.MESSAGES["document_too_large"],
        "max_document_bytes": LIMIT, "observed_bytes_at_rejection": LIMIT + 1}
    assert {r.id: r.status for r in result.documents.collect()} \
        == {"d1": "fetched", "d2": "failed"}
    failure = result.failures.first()
    assert result.failures.count() == 1
    assert (failure.stage, failure.error_class, failure.error_code) \
        == (schemas.FETCHER, "validation", "document_too_large")
    topics = {json.loads(r.payload)["document_id"]: (r.kafka_topic, r.aggregate_type)
              for r in result.outbox.collect()}
    assert topics == {"d1": (schemas.DOCUMENT_FETCHED, "document_version"),
                      "d2": (schemas.dead_letter_topic(schemas.FETCHER), "document")}
    assert result.ledger.count() == 2 and result.quarantine.count() == 0


def test_child_events_keep_the_chain(world):
    _, run = world({1: GOOD})
    payload = json.loads(run(event(1)).outbox.first().payload)
    assert payload["correlation_id"] == "c1" and payload["causation_id"] == "ev1"
    assert list(payload) == schemas.field_names(schemas.CONTRACTS["document-fetched"])
    assert isinstance(payload["byte_size"], int)


def test_unknown_version_leaves_tables_and_failures_alone(world):
    made, run = world({1: GOOD})
    result = run(event(7, at=uri(1)))
    assert result.failures.count() == 0 and result.ledger.count() == 1
    assert {r.inspection_status for r in result.versions.collect()} == {"pending"}


def test_deleted_version_is_unknown(world):
    made, run = world({1: GOOD})
    gone = made.versions.withColumn("deleted_at", F.current_timestamp())
    assert codes(run(event(1), versions=gone)) == {"d1": "unknown_source_object"}


def test_duplicates_and_ledger(world, rows):
    _, run = world({1: GOOD, 2: GOOD + "2"})
    ledger = rows(schemas.TABLES["processed_events"], ("t", "ev2", schemas.FETCHER, None, "{}"))
    other = rows(schemas.TABLES["processed_events"], ("t", "ev1", schemas.EXTRACTOR, None, "{}"))
    result = run(event(1), event(1, offset=9), event(2), ledger=ledger.union(other))
    assert codes(result) == {"d1": "valid"}
    again = run(event(1), event(2), ledger=ledger.union(result.ledger))
    assert again.outbox.count() == again.ledger.count() == 0


def test_quarantine_does_not_stop_the_batch(world):
    made, run = world({1: GOOD, 2: GOOD + "2", 3: GOOD + "3"}, stored={2: None})
    twice = made.versions.filter("document_id = 'd3'").withColumn("id", F.lit("copy"))
    result = run(event(1), event(2), event(3), event(4, at="https://x/y"), event(5, at="s3://src/"),
                 versions=made.versions.unionByName(twice))
    assert {r.document_id: r.reason for r in result.quarantine.collect()} == {
        "d2": "missing_object", "d3": "ambiguous_version", "d4": "invalid_source_uri",
        "d5": "invalid_source_uri"}
    assert codes(result) == {"d1": "valid"} and result.ledger.count() == 1


def test_last_event_of_a_batch_wins(world):
    _, run = world({1: GOOD})
    result = run(event(1, offset=1, name="a"), event(1, offset=2, name="b", kind="DocumentTouched"))
    version = result.versions.first()
    assert version.inspection_status == "invalid" and version.detected_mime_type == "application/pdf"
    assert result.documents.first().status == "failed"


def test_inspector_hook(world):
    def factory():
        def inspector(content: bytes):
            if b"locked" in content:
                return "encrypted_pdf_unsupported", None
            return None, 3

        return inspector

    _, run = world({1: GOOD, 2: "%PDF- locked", 3: "<html>"})
    result = run(event(1), event(2), event(3), factory=factory)
    assert codes(result) == {"d1": "valid", "d2": "encrypted_pdf_unsupported",
                             "d3": "invalid_pdf_signature"}
    version = result.versions.filter("document_id = 'd1'").first()
    assert json.loads(version.inspection_metadata)["preliminary_page_count"] == 3


def test_replay_makes_the_same_ids(world):
    _, run = world({1: GOOD})
    a, b = run(event(1)), run(event(1))
    assert a.outbox.collect() == b.outbox.collect()
