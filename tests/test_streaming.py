import json

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import audits, submission as sub
from docloom.operators.fetching import inspect
from docloom.operators.outbox import publish_due, registry
from docloom.session import cut_lineage
from docloom.sources import event_log as log
from docloom.sources.objects import land_objects, orphan_objects, read_landed, read_objects
from docloom.sources.snapshots import TableStore
from docloom.streaming import flows, stages
from tests.test_submission import AS_OF, DDL, row

TEXTS = {1: "%PDF-1.7 alpha", 2: "<html>", 3: "%PDF-1.7 blank", 4: "%PDF-1.7 broken"}


def converter():
    def convert(content: bytes):
        text = content.decode()
        if "broken" in text:
            raise ValueError("cannot read")
        return "{}", "" if "blank" in text else text, None

    return convert


def clock():
    return AS_OF


@pytest.fixture()
def pipeline(spark, rows, tmp_path):
    """Submit, land, publish; then functions that run the two stages and publish again."""
    root = str(tmp_path)
    data = [row(i, content=x, ext=f"e{i}", mime="application/pdf") for i, x in TEXTS.items()]
    made = sub.submit(
        rows(DDL, *data), rows("id string", ("t",)),
        spark.createDataFrame([], schemas.TABLES["documents"]),
        spark.createDataFrame([], schemas.TABLES["document_versions"]), bucket="src", as_of=AS_OF)
    store = TableStore(spark, f"{root}/tables")
    store.put_base("documents", made.documents)
    store.put_base("document_versions", made.versions)
    prepared = sub.prepare(rows(DDL, *data), "src")
    land_objects(prepared.join(rows(DDL, *data).select("seq", "content"), "seq").select(
        "tenant_id", F.col("source_object_uri").alias("object_uri"), "content",
        F.col("mime_type").alias("content_type")), f"{root}/objects")
    objects = read_landed(spark, f"{root}/objects")

    class Run:
        def publish(self, outbox):
            messages, snapshot = publish_due(cut_lineage(outbox), registry(spark), clock(), "w")
            log.write_log(messages, f"{root}/log")
            return snapshot

        def fetch(self, checkpoint="c1", files_per_trigger=None, **kw):
            source = log.stream_log(spark, f"{root}/log", schemas.DOCUMENT_SUBMITTED, files_per_trigger)
            stages.start_fetch(source, objects, store, f"{root}/{checkpoint}",
                               bucket="src", clock=clock, **kw).awaitTermination()

        def extract(self, checkpoint="c2"):
            stages.start_extract(
                log.stream_log(spark, f"{root}/log", schemas.DOCUMENT_FETCHED), objects, store, f"{root}/artifacts", f"{root}/{checkpoint}",
                factory=converter, bucket="src", artifact_bucket="art", clock=clock,
                extractor="fake", extractor_version="1").awaitTermination()

    run = Run()
    run.store, run.made, run.objects, run.root = store, made, objects, root
    return run


def added(run, table):
    return run.store.added(table)


def test_whole_chain_and_replay(spark, pipeline):
    run = pipeline
    sent = run.publish(run.made.outbox)
    assert {r.status for r in sent.collect()} == {"published"}
    run.fetch()
    assert {r.id: r.status for r in run.store.current("documents").collect()} == {
        "d1": "fetched", "d2": "failed", "d3": "fetched", "d4": "fetched"}
    assert added(run, "ingestion_failures").count() == 1

    # A second consumer state reads the whole topic again: the ledger lets nothing through twice.
    before = added(run, "ingestion_outbox").count()
    fetched_outbox = cut_lineage(added(run, "ingestion_outbox"))
    ledger = added(run, "processed_events").count()
    assert (before, ledger) == (4, 4)
    run.fetch(checkpoint="c1b")
    assert sorted(r.event_id for r in added(run, "ingestion_outbox").collect()) \
        == sorted(r.event_id for r in fetched_outbox.collect())
    assert added(run, "processed_events").count() == ledger

    run.publish(fetched_outbox)
    run.extract()
    documents = {r.id: r.status for r in run.store.current("documents").collect()}
    assert documents == {"d1": "extracted", "d2": "failed", "d3": "failed", "d4": "failed"}
    versions = {r.document_id: r for r in run.store.current("document_versions").collect()}
    assert versions["d1"].inspection_status == "valid"  # kept beside the later change
    assert versions["d1"].extraction_status == "succeeded"
    assert versions["d3"].extraction_status == "needs_review"
    assert json.loads(versions["d4"].extraction_metadata) == {"error_code": "conversion_failed"}
    kinds = [r.event_type for r in added(run, "ingestion_outbox").collect()]
    assert sorted(kinds) == sorted(["DocumentFetched"] * 3 + ["DocumentFetchRejected"]
                                   + ["ContentExtracted"] * 2 + ["ContentExtractionRejected"])
    assert orphan_objects(run.objects, run.store.current("document_versions")).count() == 0

    # Compaction keeps the tables as they are and may be followed by reading the same logs.
    want = sorted(map(str, run.store.current("document_versions").collect()))
    run.store.compact("document_versions")
    assert sorted(map(str, run.store.current("document_versions").collect())) == want

    # The declared rules hold after the run.
    broken = audits.audit({
        "documents": run.store.current("documents"),
        "document_versions": run.store.current("document_versions"),
        "processed_events": added(run, "processed_events"),
    }).filter("violations > 0").collect()
    assert broken == []


def test_records_that_do_not_fit_are_set_aside(spark, rows, pipeline):
    run = pipeline
    run.publish(run.made.outbox)
    bad = rows("topic string, key string, value string", (schemas.DOCUMENT_SUBMITTED, "k", "junk"))
    log.write_log(bad.withColumn("headers", F.array().cast(
        "array<struct<key:string,value:binary>>")), f"{run.root}/log")
    run.fetch()
    assert added(run, "processed_events").count() == 4
    path = f"{run.root}/tables/bad_records/added"
    assert [r.bad_record for r in spark.read.parquet(path).collect()] == ["junk"]


def test_later_deliveries_meet_the_ledger(spark, pipeline):
    run = pipeline
    run.publish(run.made.outbox)
    run.fetch()
    run.publish(run.made.outbox)  # every event is delivered once more, in new files
    run.fetch()
    assert added(run, "processed_events").count() == 4
    assert added(run, "ingestion_outbox").count() == 4


def test_one_file_per_batch_gives_the_same_tables(spark, pipeline):
    run = pipeline
    run.publish(run.made.outbox)
    run.publish(run.made.outbox)
    run.fetch(files_per_trigger=1)
    assert {r.id: r.status for r in run.store.current("documents").collect()} == {
        "d1": "fetched", "d2": "failed", "d3": "fetched", "d4": "fetched"}
    assert added(run, "processed_events").count() == 4


def test_binary_files_as_objects(spark, tmp_path):
    folder = tmp_path / "bucket" / "t" / "d"
    folder.mkdir(parents=True)
    (folder / "a b.pdf").write_bytes(b"%PDF-1")
    (folder / "big.pdf").write_bytes(b"x" * 50)
    (folder / "empty.pdf").write_bytes(b"")
    got = read_objects(spark, str(tmp_path / "bucket"), "src", str(tmp_path / "bucket"), 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,20)" in plan and "GreaterThan(length,20)" in plan
    assert sorted((r.object_uri, r.content and bytes(r.content), r.byte_size) for r in got.collect()) \
        == [("s3://src/t/d/a b.pdf", b"%PDF-1", 6), ("s3://src/t/d/big.pdf", None, 50)]
    sized = {r.object_uri[-7:]: r.inspection_code for r in inspect(got, max_bytes=20).collect()}
    assert sized == {"a b.pdf": None, "big.pdf": "document_too_large"}


def test_dedup_and_windows(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    rows("id bigint, s bigint, label string", (1, 0, "a"), (1, 1, "a"), (2, 14, "a"), (3, 15, "b"),
         (4, 600, "b")).selectExpr("id", "timestamp_seconds(s) AS ts", "label") \
        .write.parquet(source)
    stream = spark.readStream.schema("id bigint, ts timestamp, label string").parquet(source)
    kept = flows.dedup_within(stream, ["id"], "ts", "1 hour")
    flows.to_table(kept, str(tmp_path / "o1"), str(tmp_path / "k1")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "o1")).collect()) == [1, 2, 3, 4]
    counts = flows.outcome_windows(stream, ["label"], "ts")
    flows.to_table(counts, str(tmp_path / "o2"), str(tmp_path / "k2")).awaitTermination()
    got = {(str(r.window_start)[-8:], r.label): r.messages
           for r in spark.read.parquet(str(tmp_path / "o2")).collect()}
    assert got == {("00:00:00", "a"): 3, ("00:00:15", "b"): 1}  # the last window is still open


def test_compaction_reads_no_folded_folder_again(spark, pipeline):
    """Two batches of a run are written; the first is folded, the last one may still be replayed."""
    run = pipeline
    run.publish(run.made.outbox)
    run.fetch()
    run.publish(run.made.outbox)
    run.fetch()
    tables = ("processed_events", "document_versions", "ingestion_outbox")
    before = {t: sorted(map(str, run.store.current(t).collect())) for t in tables}
    for t in tables:
        run.store.compact(t)
        files = run.store.current(t).inputFiles()
        assert not [f for f in files if "/batch=0/" in f], files
        assert sorted(map(str, run.store.current(t).collect())) == before[t]
        run.store.compact(t)
        assert sorted(map(str, run.store.current(t).collect())) == before[t]
    run.publish(run.made.outbox)
    run.fetch()
    assert added(run, "processed_events").count() == 4


def test_stages_publish_from_the_store(spark, pipeline):
    """Outbox rows the fetch stage stored are sent once, and the extract stage reads them."""
    run = pipeline
    run.publish(run.made.outbox)
    run.fetch()
    sent = []

    def send(messages):
        sent.append(messages.count())
        log.write_log(messages, f"{run.root}/log")

    for number in (0, 1):
        stages.publish_stored(run.store, send, "r", number, as_of=clock(), worker="w")
    assert sent == [4, 0]
    assert {r.status for r in run.store.current("ingestion_outbox").collect()} == {"published"}
    run.extract()
    assert {r.id: r.status for r in run.store.current("documents").collect()} == {
        "d1": "extracted", "d2": "failed", "d3": "failed", "d4": "failed"}
    assert run.store.added("quarantine").collect() == [] and run.store.added("bad_records").collect() == []


def test_first_copy_is_the_same_however_files_are_split(spark, rows, tmp_path):
    """Two copies of an event: the one written first wins, in any order of the files of a batch."""
    path, out = str(tmp_path / "log"), []
    for n in range(2):
        log.write_log(rows("topic string, key string, value string", *[("t", f"{n}{i}", f"v{n}") for i in range(50)])
                      .coalesce(1).withColumn("headers", F.array().cast("array<struct<key:string,value:binary>>")), path)
    for split in (1 << 28, 900):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        log.stream_log(spark, path, "t").writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / f"c{split}")) \
            .foreachBatch(lambda df, _: out.append([r.key for r in df.orderBy("position").collect()])) \
            .start().awaitTermination()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert out[0] == out[1] == [f"{n}{i}" for n in range(2) for i in range(50)]


def test_object_files_query_reads_the_folder(spark, tmp_path):
    """A table file, an empty one, one above the limit and one of another format."""
    import hashlib

    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"plain")
    (tmp_path / "large.bin").write_bytes(b"PAR1" + b"x" * (1 << 20))
    from docloom.plans import all_queries

    got = {r.object_uri.split("/")[-1]: r for r in all_queries()["object_files"](spark, str(tmp_path)).collect()}
    for path in tmp_path.rglob("*"):
        if path.is_file() and not path.name.startswith((".", "_")) and path.stat().st_size:
            row, content = got.pop(path.name), path.read_bytes()
            want = "document_too_large" if len(content) > 1 << 20 else "valid" if content.startswith(b"PAR1") else "invalid_pdf_signature"
            assert (row.byte_size, row.outcome) == (len(content), want)
            assert row.content_sha256 == (hashlib.sha256(content).hexdigest() if want == "valid" else None)
    assert not got
