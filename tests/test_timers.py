import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import outbox as box
from docloom.operators.tables import conform
from docloom.streaming import flows, timers


def put(rows, path, ddl, *data):
    """One more file of a folder that a stream reads file by file."""
    rows(ddl, *data).selectExpr("* EXCEPT (s)", "timestamp_seconds(s) AS ts").coalesce(1).write.mode("append").parquet(path)


def drained(stream, out, checkpoint):
    flows.to_table(stream, out, checkpoint).awaitTermination()


def test_late_and_repeated_rows_are_counted(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    ddl = "id bigint, tag string, s bigint"

    def run():
        stream = spark.readStream.schema("id bigint, tag string, ts timestamp") \
            .option("maxFilesPerTrigger", 1).parquet(source)
        drained(timers.deduplicated(stream, ["id"], "ts", "10 seconds", 100), out, checkpoint)

    put(rows, source, ddl, (1, "first", 1000), (1, "again", 1001), (2, "first", 1005))
    put(rows, source, ddl, (3, "first", 1060), (2, "again", 1050))
    run()
    # A new query goes on from the checkpoint: the watermark stands at 1050.
    put(rows, source, ddl, (4, "behind", 1020), (1, "behind again", 1002), (5, "first", 1200))
    run()
    put(rows, source, ddl, (1, "behind", 1010), (6, "first", 1300))  # key 1 was forgotten at 1100
    run()
    got = sorted((r.id, r.tag, r.outcome) for r in spark.read.parquet(out).collect())
    assert got == sorted([
        (1, "first", "accepted"), (1, "again", "duplicate"), (2, "first", "accepted"), (3, "first", "accepted"),
        (2, "again", "duplicate"), (4, "behind", "late"), (1, "behind again", "duplicate"), (5, "first", "accepted"),
        (1, "behind", "late"), (6, "first", "accepted")])


def test_windows_count_late_rows(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    ddl = "label string, s bigint"

    def run():
        stream = spark.readStream.schema("label string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)
        drained(timers.counted_windows(stream, ["label"], "ts", 15, "30 seconds"), out, checkpoint)

    put(rows, source, ddl, ("a", 1), ("a", 14), ("b", 14), ("a", 16))
    put(rows, source, ddl, ("a", 2), ("a", 100))
    run()
    put(rows, source, ddl, ("a", 3), ("b", 4), ("b", 99))
    run()
    got = [(r.window_start.second, r.label, r.messages, r.late) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [(0, "a", 0, 1), (0, "a", 3, 0), (0, "b", 0, 1), (0, "b", 1, 0), (15, "a", 1, 0)]
    # ("a", 100) and ("b", 99) are in windows that are still open.
    assert sum(m + late for _, _, m, late in got) == 9 - 2


def outbox_rows(spark, rows):
    fit = ('{"event_id":"e","event_type":"t","occurred_at":"o","correlation_id":"c","causation_id":null,"tenant_id":"t",'
           '"document_id":"d","payload_uri":"u","schema_version":"1.0.0"}')
    data = [("good", "pending", fit, 1000, 0), ("bad", "pending", "{}", 1000, 0), ("later", "failed", fit, 1005, 3),
            ("worse", "failed", "[]", 1003, 1), ("held", "publishing", fit, 1000, 0)]
    return conform(rows("id string, status string, payload string, s bigint, attempt_count int", *data).selectExpr(
        "id", "'t' AS tenant_id", "id AS event_id", "'document' AS aggregate_type", "'a' AS aggregate_id", "'t' AS event_type",
        "'topic' AS kafka_topic", "'' AS event_contract_namespace", "'document-submitted' AS event_schema_name", "payload",
        "'{}' AS headers", "status", "attempt_count", "timestamp_seconds(s) AS available_at",
        "timestamp_seconds(900) AS created_at"), schemas.TABLES["ingestion_outbox"])


def test_retries_wait_for_their_time_and_end_as_polling_does(spark, rows, tmp_path):
    """Three tries of a row that never fits, over two restarts from the checkpoint."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    start = outbox_rows(spark, rows)

    def run():
        stream = spark.readStream.schema(start.schema).option("maxFilesPerTrigger", 1).parquet(source)
        checked = box.with_publish_error(stream, box.registry(spark))
        drained(timers.publishing(checked, "created_at"), out, checkpoint)

    def tick(second):
        """A row of another worker: it is not tried, but moves the watermark."""
        start.filter("id = 'good'").withColumn("id", F.lit(f"tick{second}")).withColumn("status", F.lit("publishing")) \
            .withColumn("created_at", F.timestamp_seconds(F.lit(second))).coalesce(1).write.mode("append").parquet(source)

    start.coalesce(1).write.mode("append").parquet(source)
    for second in (1001, 1004):
        tick(second)
        run()
    for second in (1007, 1010, 1011):
        tick(second)
    run()
    tries = [(r.id, r.attempt_count, int(r.tried_at.timestamp())) for r in spark.read.parquet(out).collect()]
    assert sorted(t for t in tries if t[0] in ("bad", "worse")) == [
        ("bad", 1, 1000), ("bad", 2, 1002), ("bad", 3, 1006), ("worse", 2, 1003), ("worse", 3, 1007)]

    snapshot = start
    for second in range(1000, 1011):
        _, snapshot = box.publish_due(snapshot, box.registry(spark), f"1970-01-01 00:{second // 60}:{second % 60:02}", "w")
        snapshot = spark.createDataFrame(snapshot.collect(), start.schema)
    want = {r.id: (r.status, r.attempt_count, r.last_error) for r in snapshot.collect() if r.id != "held"}
    last = spark.read.parquet(out).groupBy("id").agg(F.max_by(F.struct("status", "attempt_count", "last_error"), "attempt_count").alias("x"))
    assert {r.id: tuple(r.x) for r in last.collect()} == want


def test_state_entries_do_not_grow_with_the_keys(spark, rows, tmp_path, monkeypatch):
    """Two hundred keys in eight buckets: an entry and a timer a bucket, in Spark's counts an entry and two rows."""
    monkeypatch.setattr(timers, "BUCKETS", 8, raising=False)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(rows, source, "id bigint, s bigint", *((i % 200 or None, 1000 + i // 200) for i in range(400)))
    stream = spark.readStream.schema("id bigint, ts timestamp").parquet(source)
    query = flows.to_table(timers.deduplicated(stream, ["id"], "ts", "10 seconds", 100), out, checkpoint)
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] <= 3 * 8
    counts = {(r.id, r.outcome): r["count"] for r in spark.read.parquet(out).groupBy("id", "outcome").count().collect()}
    assert counts == {(i or None, kind): 1 for i in range(200) for kind in ("accepted", "duplicate")}
