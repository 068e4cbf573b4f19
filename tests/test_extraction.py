import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.json_text import canonical_json, spaced_json, strip_binary
from docloom.functions.markup import detected_type, figure_evidence, html_text
from docloom.operators import extraction as ext
from docloom.session import cut_lineage
from docloom.session import cut_lineage
from docloom.sources.objects import bucketed, land_bucketed, open_bucketed, read_artifacts, write_artifacts

AS_OF = "2024-05-01 12:00:00"
LIMIT = 60
EVENTS = ("tenant_id string, document_id string, event_id string, event_type string, "
          "correlation_id string, document_version_id string, payload_uri string, "
          "detected_mime_type string, content_sha256 string, inspection_status string, "
          "event_offset bigint")


def converter():
    def convert(content: bytes):
        text = content.decode()
        if "broken" in text:
            raise ValueError("cannot read")
        if "shapeless" in text:
            return "[]", text, None
        tree = {"pictures": [{"self_ref": "#/p/0", "captions": ["c"], "image": "AA"}],
                "tables": [{}, {}]}
        return json.dumps(tree), " \n\u2003" if "blank" in text else text, None

    return convert


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def event(i, text, kind="DocumentFetched", mime="application/pdf", status="valid", digest=None,
          version=None, at=None):
    return ("t", f"d{i}", f"e{i}", kind, f"c{i}", version or f"v{i}", at or f"s3://src/o{i}", mime,
            digest or sha(text), status, i)


@pytest.fixture()
def run(spark, rows):
    def go(texts, *events, ledger=None, lost=()):
        versions = rows(
            "id string, tenant_id string, document_id string, content_sha256 string, "
            "extraction_status string, extraction_metadata string, extraction_config string, "
            "normalized_object_uri string, extraction_manifest_uri string, updated_at timestamp, "
            "deleted_at timestamp",
            *[(f"v{i}", "t", f"d{i}", sha(x), "pending", "{}", "{}", None, None, None, None)
              for i, x in texts.items()])
        documents = rows("id string, tenant_id string, status string, updated_at timestamp",
                         *[(f"d{i}", "t", "fetched", None) for i in texts])
        objects = rows("object_uri string, content string",
                       *[(f"s3://src/o{i}", x) for i, x in texts.items() if i not in lost])
        return ext.extract_stage(
            rows(EVENTS, *events), objects, versions, documents,
            ledger or spark.createDataFrame([], schemas.TABLES["processed_events"]),
            factory=converter, bucket="src", artifact_bucket="art", as_of=AS_OF,
            extractor="fake", extractor_version="9", max_bytes=LIMIT, store=cut_lineage)

    return go


def codes(result):
    return {p["document_id"]: p.get("error_code", p.get("extraction_status"))
            for p in (json.loads(r.payload) for r in result.stage.outbox.collect())}


def test_every_code_and_precedence(run):
    long = "x" * (LIMIT + 1)
    texts = {1: "fine", 2: "b", 3: long, 4: "", 5: "broken", 6: "six", 7: "seven", 8: "shapeless",
             9: "nine", 10: "broken too", 11: "blank"}
    result = run(
        texts,
        event(1, "fine"),
        event(2, "b", kind="DocumentTouched", status="invalid"),  # type before support
        event(3, long, digest="0" * 64),                          # size before checksum
        event(4, "", digest="0" * 64),                            # empty before checksum
        event(5, "broken"),
        event(6, "six", digest="0" * 64, version="other"),        # checksum before version
        event(7, "seven", version="other"),
        event(8, "shapeless"),
        event(9, "nine", mime="text/html"),
        event(10, "broken too", digest="0" * 64),                 # conversion before checksum
        event(11, "blank"))
    assert codes(result) == {
        "d1": "succeeded", "d2": "unexpected_event_type", "d3": "source_too_large",
        "d4": "empty_source", "d5": "conversion_failed", "d6": "source_checksum_mismatch",
        "d7": "unknown_document_version", "d8": "invalid_converter_output",
        "d9": "unsupported_source", "d10": "conversion_failed", "d11": "needs_review"}


def test_writes(run):
    result = run({1: "fine", 2: "blank", 3: "broken"},
                 event(1, "fine"), event(2, "blank"), event(3, "broken"))
    versions = {r.id: r for r in result.stage.versions.collect()}
    documents = {r.id: r.status for r in result.stage.documents.collect()}
    assert [versions[f"v{i}"].extraction_status for i in (1, 2, 3)] \
        == ["succeeded", "needs_review", "failed"]
    # Review means failed for the document, yet its extracted event goes out.
    assert documents == {"d1": "extracted", "d2": "failed", "d3": "failed"}
    topics = {r.aggregate_id: r.kafka_topic for r in result.stage.outbox.collect()}
    assert topics == {"v1": schemas.CONTENT_EXTRACTED, "v2": schemas.CONTENT_EXTRACTED,
                      "v3": schemas.dead_letter_topic(schemas.EXTRACTOR)}
    assert json.loads(versions["v1"].extraction_metadata) == {
        "source_bytes": 4, "text_characters": 4, "table_count": 2, "figure_count": 1,
        "empty_text": False, "visual_interpretation": "not_performed"}
    assert json.loads(versions["v3"].extraction_metadata) == {"error_code": "conversion_failed"}
    assert json.loads(versions["v1"].extraction_config) \
        == {"extractor": "fake", "extractor_version": "9"}
    assert versions["v1"].normalized_object_uri \
        == f"s3://art/t/v1/extracted/{sha('fine')}/normalized.json"
    assert versions["v3"].normalized_object_uri is None
    assert result.stage.failures is None


def test_artifacts_are_canonical_and_left_by_unknown_versions(spark, run, tmp_path):
    result = run({1: "fine", 2: "seven", 3: "broken"},
                 event(1, "fine"), event(2, "seven", version="other"), event(3, "broken"))
    bodies = {r.object_uri: r.body for r in result.artifacts.collect()}
    assert len(bodies) == 4
    text = bodies[f"s3://art/t/v1/extracted/{sha('fine')}/normalized.json"]
    value = json.loads(text)
    assert text == json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert value["markdown"] == "fine" and value["schema_version"] == "1.0.0"
    assert value["figures"] == [{"captions": ["c"], "figure_index": 0, "provenance": [],
                                 "self_ref": "#/p/0"}]
    assert "image" not in json.dumps(value["document"])
    manifest = json.loads(bodies[f"s3://art/t/v1/extracted/{sha('fine')}/manifest.json"])
    assert set(manifest) == {"extractor", "extractor_version", "quality", "extraction_status",
                             "source_content_sha256"}
    for _ in range(2):  # a retry writes the same keys
        write_artifacts(result.artifacts, str(tmp_path / "artifacts"))
    assert read_artifacts(spark, str(tmp_path / "artifacts")).count() == 4
    write_artifacts(result.artifacts, str(tmp_path / "artifacts"), "batch=1")  # another batch does so too
    assert {r.object_uri: r.body for r in read_artifacts(spark, str(tmp_path / "artifacts")).collect()} == bodies
    assert read_artifacts(spark, str(tmp_path / "artifacts")).count() == 4


def test_content_and_bodies_stay_in_their_buckets(spark, rows, tmp_path):
    """No exchange of the stage carries content, text or tree, with broadcasts off."""
    objects = land_bucketed(rows("object_uri string, content string, content_type string, tenant_id string",
                                 *[(f"s3://src/t/d{i}", f"text {i}", "x", "t") for i in range(40)]), str(tmp_path / "o"), 4)
    again = open_bucketed(spark, str(tmp_path / "o"), "object_uri string, content binary, content_type string, "
                          "content_sha256 string, tenant_id string", "object_uri", 4)
    events = rows("event_id string, event_type string, correlation_id string, tenant_id string, document_id string, "
                  "document_version_id string, payload_uri string, detected_mime_type string, content_sha256 string, "
                  "inspection_status string, event_offset bigint",
                  *[(f"e{i}", "DocumentFetched", "c", "t", f"d{i}", f"v{i}", f"s3://src/t/d{i}", "application/pdf",
                     sha(f"text {i}"), "valid", i) for i in range(0, 40, 2)])
    versions = rows(schemas.TABLES["document_versions"]).unionByName(rows(
        "id string, tenant_id string, document_id string, content_sha256 string, source_object_uri string, byte_size bigint",
        *[(f"v{i}", "t", f"d{i}", sha(f"text {i}"), f"s3://src/t/d{i}", 5) for i in range(40)]), allowMissingColumns=True)
    documents = rows(schemas.TABLES["documents"])
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return bucketed(df, str(tmp_path / "bodies"), "object_uri", 4, dealt=True)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = ext.extract_stage(
            events, again, versions, documents, rows(schemas.TABLES["processed_events"]), factory=lambda: lambda c: ("{}", c.decode(), None),
            bucket="src", artifact_bucket="art", as_of="2024-01-01 00:00:00", extractor="x", extractor_version="1",
            store=cut_lineage, store_bodies=seen)
        plans.append(made.artifacts._jdf.queryExecution().executedPlan().toString())
        got = {r.object_uri: r.body for r in made.artifacts.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 40 and objects.count() == 40
    assert json.loads(got[f"s3://art/t/v2/extracted/{sha('text 2')}/normalized.json"])["markdown"] == "text 2"
    for plan in plans:
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                below = lines[i + 1]
                assert not any(f"{c}#" in below for c in ("content", "markdown", "tree", "document")), below
        assert "Bucketed: true" in plan


def test_quarantine_and_ledger(run, rows):
    ledger = rows(schemas.TABLES["processed_events"], ("t", "e1", schemas.EXTRACTOR, None, "{}"))
    result = run({1: "fine", 2: "b", 3: "c"}, event(1, "fine"), event(2, "b", at="nowhere"),
                 event(3, "c"), ledger=ledger, lost=(3,))
    assert {r.document_id: r.reason for r in result.stage.quarantine.collect()} \
        == {"d2": "invalid_source_uri", "d3": "missing_object"}
    assert result.stage.outbox.count() == result.stage.ledger.count() == 0


def test_empty_objects_come_back_from_the_versions(rows):
    objects = rows("object_uri string, content binary", ("s3://src/a", bytearray(b"x")))
    versions = rows("source_object_uri string, byte_size bigint",
                    ("s3://src/a", 1), ("s3://src/b", 0), ("s3://src/c", 5))
    got = {r.object_uri: bytes(r.content)
           for r in ext.with_empty_objects(objects, versions).collect()}
    assert got == {"s3://src/a": b"x", "s3://src/b": b""}


def test_strip_binary_at_any_depth(rows):
    text = json.dumps({"Image": 1, "a": [{"DATA": "x", "b": {"base64": "y", "keep": None}}, [
        {"pixels": 1}], 2.5, True], "é": "ü"})
    df = rows("j string", (text,), ("not json",), (None,))
    got = [r[0] for r in df.select(strip_binary("j")).collect()]
    assert json.loads(got[0]) == {"a": [{"b": {"keep": None}}, [{}], 2.5, True], "é": "ü"}
    assert got[1] is None and got[2] is None


def test_figure_evidence_keeps_places_and_null_refs(rows):
    pictures = ["text", {"self_ref": None, "prov": [{"page_no": 1}]}, {"captions": ["x"]}, 5,
                {"self_ref": "#/p/4"}]
    df = rows("j string", (json.dumps({"pictures": pictures}),), ('{"pictures": 5}',), ("{}",))
    got = df.select(F.to_json(figure_evidence(F.parse_json("j")))).collect()
    assert json.loads(got[0][0]) == [
        {"figure_index": 1, "self_ref": "None", "captions": [], "provenance": [{"page_no": 1}]},
        {"figure_index": 2, "self_ref": "", "captions": ["x"], "provenance": []},
        {"figure_index": 4, "self_ref": "#/p/4", "captions": [], "provenance": []}]
    assert got[1][0] == got[2][0] == "[]"


def test_json_text(rows):
    df = rows("a string, n bigint, b boolean", ('q"\\', 3, False))
    out = df.select(
        spaced_json([("a", F.col("a"), None), ("n", F.col("n"), None), ("b", F.col("b"), None),
                     ("skip", F.col("n"), F.lit(False)), ("z", F.lit(None).cast("string"), None)]),
        canonical_json(b=F.col("n"), a=F.lit(None).cast("string"))).first()
    assert out[0] == json.dumps({"a": 'q"\\', "n": 3, "b": False, "z": None})
    assert out[1] == '{"a":null,"b":3}'


@pytest.mark.parametrize("content, kind", [
    (b"%PDF-1.4", "application/pdf"),
    (b"PK\x03\x04....word/document.xml", "application/vnd.openxmlformats-officedocument."
                                         "wordprocessingml.document"),
    (b"PK\x03\x04....xl/workbook.xml", "application/vnd.openxmlformats-officedocument."
                                       "spreadsheetml.sheet"),
    (b"PK\x03\x04....readme", "application/zip"),
    (b"\x89PNG\r\n\x1a\n", "image/png"),
    (b"II*\x00", "image/tiff"),
    (b" \n<!DOCTYPE HTML><html>", "text/html"),
    (b"Subject: hi", "message/rfc822"),
    (b"plain", "text/plain"),
])
def test_detected_type(rows, content, kind):
    assert rows("c binary", (bytearray(content),)).select(detected_type("c")).first()[0] == kind


def test_html_text(rows):
    html = "<html><style>p{}</style><script>var a='<p>';</script><!-- x --><p>One\n <b>two</b></p>"
    assert rows("h string", (html,)).select(html_text("h")).first()[0] == "One two"


def test_a_converter_holds_a_bounded_piece_of_a_batch(spark, rows):
    """Spark's batches are bounded by bytes, and a batch is converted piece by piece."""
    import pyarrow as pa

    from docloom.session import BATCH_BYTES

    sizes = [3, None, 0, ext.PIECE_BYTES - 3, 1, 2 * ext.PIECE_BYTES, None, 5]
    batch = pa.RecordBatch.from_pydict({"i": list(range(8)), "content": [None if n is None else bytes(n) for n in sizes]})
    assert [p.column("i").to_pylist() for p in ext._pieces(batch, "content")] == [[0, 1, 2, 3], [4], [5], [6, 7]]

    before = spark.conf.get(BATCH_BYTES)
    try:
        spark.conf.set(BATCH_BYTES, str(64 << 20))
        big = "x" * (1 << 20)
        made = ext.convert(rows("object_uri string, content string", *((str(i), big if i % 2 else None) for i in range(20))),
                           lambda: lambda content: (None, str(len(content)), None))
        assert int(spark.conf.get(BATCH_BYTES)) <= 2 * ext.PIECE_BYTES
        assert {r.object_uri: r.markdown for r in made.collect()} == {str(i): str(1 << 20) if i % 2 else None for i in range(20)}
    finally:
        spark.conf.set(BATCH_BYTES, before)
