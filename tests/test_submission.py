import hashlib

from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import submission as sub

AS_OF = "2024-05-01 12:00:00"
DDL = ("seq bigint, tenant_id string, document_id string, filename string, title string, "
       "source_external_id string, mime_type string, classification string, "
       "declared_bytes bigint, content string")


def row(seq, tenant="t", name="a.pdf", title=None, ext=None, mime=None, cls=None, size=None,
        content=None):
    return (seq, tenant, f"d{seq}", name, title, ext, mime, cls, size, content or f"body {seq}")


def submit(spark, rows, data, documents=None, versions=None, max_bytes=100):
    return sub.submit(
        rows(DDL, *data), rows("id string", ("t",), ("u",)),
        documents or spark.createDataFrame([], schemas.TABLES["documents"]),
        versions or spark.createDataFrame([], schemas.TABLES["document_versions"]),
        bucket="src", as_of=AS_OF, max_bytes=max_bytes)


def codes(result):
    return {r.seq: r.status_code for r in result.outcomes.collect()}


def test_defaults_treat_empty_as_missing(rows):
    out = sub.prepare(rows(DDL, row(1, title="", ext="", mime="", name="a/b\\c.pdf")), "src").first()
    assert out.title == "a/b\\c.pdf"
    assert out.source_external_id == "d1"
    assert out.mime_type == "application/octet-stream"
    assert out.classification == "internal"
    assert out.object_key == "t/d1/original/a_b_c.pdf"
    assert out.source_object_uri == "s3://src/t/d1/original/a_b_c.pdf"
    assert out.content_sha256 == hashlib.sha256(b"body 1").hexdigest()


def test_classification_default_only_when_absent(rows):
    out = sub.prepare(rows(DDL, row(1, cls="")), "src").first()
    assert out.classification == ""


def test_status_codes_and_their_order(spark, rows):
    long = "x" * 101
    result = submit(spark, rows, [
        row(1),
        row(2, name=""),
        row(3, content=long),
        row(4, name=None, size=500),        # declared length is looked at first
        row(5, name="", content=long),      # the name before the body
        row(6, tenant="nobody"),            # unknown tenant reads as a conflict
    ])
    assert codes(result) == {1: 201, 2: 422, 3: 413, 4: 413, 5: 422, 6: 409}


def test_conflicts_inside_the_batch_and_with_stored_rows(spark, rows):
    first = submit(spark, rows, [row(1, ext="e1", content="one"), row(2, ext="e1", content="two"),
                                 row(3, ext="e3", content="two"), row(4, ext="e4", content="one"),
                                 row(5, tenant="u", ext="e1", content="one")])
    assert codes(first) == {1: 201, 2: 409, 3: 201, 4: 409, 5: 201}
    second = submit(spark, rows, [row(6, ext="e1", content="new"), row(7, ext="e7", content="two"),
                                  row(8, ext="e8", content="fresh")],
                    first.documents, first.versions)
    assert codes(second) == {6: 409, 7: 409, 8: 201}


def test_fan_out_rows_belong_together(spark, rows):
    result = submit(spark, rows, [row(1, ext="e1"), row(2, name="")])
    document, version, event = (x.first() for x in result[1:])
    assert result.documents.count() == result.versions.count() == result.outbox.count() == 1
    assert document.status == "submitted" and document.source_system == "api"
    assert document.current_version_id == version.id and version.version_number == 1
    assert version.inspection_status == version.extraction_status == "pending"
    assert event.aggregate_type == "document" and event.aggregate_id == document.id
    assert event.kafka_topic == schemas.DOCUMENT_SUBMITTED and event.status == "pending"
    payload = result.outbox.select(F.from_json(
        "payload", schemas.CONTRACTS["document-submitted"]).alias("p")).first().p
    assert payload.event_id == payload.correlation_id == event.event_id
    assert payload.causation_id is None and payload.payload_uri == version.source_object_uri
