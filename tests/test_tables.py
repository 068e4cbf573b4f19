import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id
from docloom.functions.keys import guessed_mime, object_key
from docloom.operators import access, audits, chunking, lineage, metrics, tables

AS_OF = "2024-05-01 12:00:00"


def test_upsert_overlays_non_null_values_and_touches_changed_rows(rows):
    base = rows("id string, a string, b string, updated_at timestamp",
                ("1", "x", "y", None), ("2", "p", "q", None))
    changes = rows("id string, a string, b string", ("1", "new", None), ("3", "n", "m"))
    got = {r.id: r for r in tables.upsert(base, changes, ["id"], AS_OF, insert=True).collect()}
    assert (got["1"].a, got["1"].b) == ("new", "y") and got["1"].updated_at is not None
    assert got["2"].updated_at is None and got["3"].a == "n"
    assert set(r.id for r in tables.upsert(base, changes, ["id"], AS_OF).collect()) == {"1", "2"}


def test_tenant_scope(rows):
    df = rows("tenant_id string, v int", ("a", 1), ("b", 2), (None, 3))
    assert [r.v for r in tables.tenant_scope(df, "a").collect()] == [1]
    assert tables.tenant_scope(df, None).count() == 0
    assert sorted(r.v for r in tables.outside_scope(df, "a").collect()) == [2, 3]


def test_tenant_scope_prunes_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows("tenant_id string, v int", ("a", 1), ("b", 2)).write.partitionBy("tenant_id").parquet(path)
    stored = tables.tenant_scope(spark.read.schema("v int, tenant_id string").parquet(path), "a")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan and stored.count() == 1


def test_versions(rows):
    stored = rows("tenant_id string, document_id string, id string, version_number int, "
                  "deleted_at timestamp",
                  ("t", "d", "v1", 1, None), ("t", "d", "v2", 2, None), ("t", "e", "w1", 1, None))
    gone = stored.withColumn("deleted_at", F.when(F.col("id") == "v2", F.current_timestamp()))
    assert {r.id for r in tables.latest_versions(stored).collect()} == {"v2", "w1"}
    assert {r.id for r in tables.latest_versions(gone).collect()} == {"v1", "w1"}
    incoming = rows("tenant_id string, document_id string, id string, seq bigint",
                    ("t", "d", "v4", 9), ("t", "d", "v3", 5), ("t", "n", "n1", 7))
    got = {r.id: r.version_number
           for r in tables.number_versions(incoming, stored, "seq").collect()}
    assert got == {"v3": 3, "v4": 4, "n1": 1}


def test_object_keys(rows):
    df = rows("u string", ("s3://src/a/b.pdf",), ("S3://src//a",), ("s3://other/a",),
              ("s3://src/",), ("s3://src",), ("https://src/a",), ("s3://src/a?x=1",),
              ("s3://src/a b",), (None,))
    assert [r[0] for r in df.select(object_key("u", "src")).collect()] \
        == ["a/b.pdf", "a", None, None, None, None, "a", "a b", None]


def test_guessed_mime(rows):
    df = rows("n string", ("A.PDF",), ("x.docx",), ("noext",), ("x.unknown",))
    got = [r[0] for r in df.select(guessed_mime("n")).collect()]
    assert got[0] == "application/pdf" and got[1].endswith("wordprocessingml.document")
    assert got[2] == got[3] == "application/octet-stream"


def test_audit_finds_each_kind_of_violation(spark, rows):
    tenants = rows("id string, slug string, display_name string, status string, "
                   "created_at timestamp, updated_at timestamp",
                   ("t", "good-slug", "T", "active", None, None), ("u", "Bad", "U", "odd", None, None))
    acl = rows("id string, tenant_id string, document_id string, principal_type string, "
               "principal_id string, permission string, created_at timestamp",
               ("1", "t", "d", "user", "a", "read", None), ("2", "t", "d", "user", "a", "read", None),
               ("3", "t", "x", "robot", "a", "read", None), ("4", "nobody", "d", "user", "b", "write", None))
    found = {(r.table, r.rule): r.violations
             for r in audits.audit({"tenants": tenants, "document_acl": acl}).collect()}
    assert found[("tenants", "slug_shape")] == 1 and found[("tenants", "status_value")] == 1
    assert found[("tenants", "created_at_not_null")] == 2
    assert found[("document_acl", "principal_type_value")] == 1
    assert found[("document_acl", "permission_value")] == 1
    assert found[("document_acl", "tenant_id_in_tenants")] == 1
    assert found[("document_acl",
                  "unique_tenant_id_document_id_principal_type_principal_id_permission")] == 1
    assert found[("document_acl", "unique_id")] == 0


def test_partial_references_pass(rows):
    child = rows("tenant_id string, v string", ("t", "1"), ("t", None), ("t", "9"))
    parent = rows("tenant_id string, id string", ("t", "1"))
    got = audits.reference_check("c", child, ["tenant_id", "v"], parent, ["tenant_id", "id"], "p")
    assert got.first().violations == 1


def test_chunk_rules(rows):
    ddl = ("id string, chunk_index int, content_sha256 string, page_from int, page_to int, "
           "token_count int, character_count int")
    ok = "a" * 64
    df = rows(ddl, ("good", 0, ok, 1, 2, 1, 1), ("nopage", 0, ok, None, None, 1, 1),
              ("neg", -1, ok, 1, 1, 1, 1), ("sha", 0, "A" * 64, 1, 1, 1, 1),
              ("range", 0, ok, 3, 2, 1, 1), ("two", 0, ok, 0, 0, 0, 1))
    got = {r.id: r.broken_rules for r in audits.chunk_violations(df).collect()}
    assert got == {"neg": ["chunk_index_not_negative"], "sha": ["sha_shape"],
                   "range": ["page_range"], "two": ["page_from_positive", "token_count_positive"]}


def test_unfinished_and_gaps(rows):
    df = rows("id string, s string", ("a", "done"), ("b", "open"), ("c", None))
    assert {r.id for r in audits.unfinished(df, "s", ["done"]).collect()} == {"b", "c"}
    gaps = {r.rule: r.violations for r in audits.lineage_gaps(df, ["id", "s"]).collect()}
    assert gaps == {"id_not_null": 0, "s_not_null": 1}


def test_access(rows):
    acl = rows("tenant_id string, document_id string, principal_type string, principal_id string, "
               "permission string",
               ("t", "d1", "user", "ann", "read"), ("t", "d1", "group", "g", "read"),
               ("t", "d1", "group", "g", "manage"), ("t", "d2", "role", "r", "manage"),
               ("u", "d1", "user", "bob", "read"))
    lists = {(r.tenant_id, r.document_id): r.acl_principals
             for r in access.acl_principals(acl).collect()}
    assert lists == {("t", "d1"): ["group:g", "user:ann"], ("t", "d2"): ["role:r"],
                     ("u", "d1"): ["user:bob"]}
    documents = rows("tenant_id string, id string, deleted_at timestamp",
                     ("t", "d1", None), ("t", "d2", None), ("u", "d1", None))
    def ids(*args):
        return {(r.tenant_id, r.id)
                for r in access.readable_documents(documents, acl, *args).collect()}
    assert ids(["group:g", "user:ann"]) == {("t", "d1")}
    assert ids(["role:r"]) == {("t", "d2")} and ids(["role:r"], ["read"]) == set()
    points = rows("tenant_id string, p string, is_active boolean, acl_principals array<string>",
                  ("t", "1", True, ["user:ann"]), ("t", "2", False, ["user:ann"]),
                  ("u", "3", True, ["user:ann"]), ("t", "4", True, ["user:bob"]), ("t", "5", True, []))
    assert [r.p for r in access.visible_points(points, "t", ["user:ann"]).collect()] == ["1"]
    assert access.visible_points(points, "t", []).count() == 0
    assert access.visible_points(points, None, ["user:ann"]).count() == 0


@pytest.mark.parametrize("size, overlap", [(3, 0), (3, 1), (4, 3), (100, 0)])
def test_chunks_cover_the_whole_text(rows, size, overlap):
    texts = {"a": " ".join(f"w{i}" for i in range(10)), "b": "one", "c": " \n ", "d": "x  y\tz"}
    df = rows("tenant_id string, document_version_id string, text string",
              *[("t", k, x) for k, x in texts.items()])
    got = chunking.text_chunks(df, size, overlap).orderBy("document_version_id", "chunk_index")
    found = {}
    for r in got.collect():
        found.setdefault(r.document_version_id, []).append(r.chunk_text)
        assert r.chunk_index == len(found[r.document_version_id]) - 1
    for key, text in texts.items():
        words, want, i = text.split(), [], 0
        while words and (i == 0 or i + overlap < len(words)):
            want.append(" ".join(words[i:i + size]))
            i += size - overlap
        assert found.get(key, []) == want


def test_chunk_rows_are_repeatable_and_valid(rows):
    df = rows("tenant_id string, document_version_id string, text string", ("t", "v", "a b c d e"))
    made = [chunking.chunk_rows(chunking.text_chunks(df, 2), as_of=AS_OF, strategy="s", model="m",
                                model_version="1") for _ in range(2)]
    assert made[0].collect() == made[1].collect()
    assert made[0].columns == schemas.field_names(schemas.TABLES["chunks"])
    assert audits.chunk_violations(made[0]).count() == 0
    assert [r.section_path for r in chunking.reading_order(made[0]).collect()] \
        == [["tokens:0-1"], ["tokens:2-3"], ["tokens:4-4"]]
    with pytest.raises(ValueError):
        chunking.text_chunks(df, 2, 2)


def test_lineage(rows):
    events = rows("correlation_id string, event_id string, causation_id string, event_type string, "
                  "occurred_at timestamp")
    df = events.sparkSession.createDataFrame(
        [("c", "1", None, "A"), ("c", "2", "1", "B"), ("c", "3", "2", "C"), ("x", "9", "1", "D")],
        "correlation_id string, event_id string, causation_id string, event_type string")
    links = {(r.event_id, r.causation_id, r.parent_type) for r in lineage.causal_links(df).collect()}
    assert links == {("2", "1", "A"), ("3", "2", "B")}


def test_metrics(rows):
    docs = rows("tenant_id string, status string, deleted_at timestamp",
                ("t", "ready", None), ("t", "ready", None), ("t", "failed", None))
    assert {(r.status, r.documents) for r in metrics.status_funnel(docs).collect()} \
        == {("ready", 2), ("failed", 1)}
    wide = metrics.status_matrix(docs, schemas.DOCUMENT_STATUS).first()
    assert (wide.ready, wide.failed, wide.deleted) == (2, 1, 0)


def test_audit_reads_each_table_once_and_counts_in_two_shuffles(spark, rows, tmp_path):
    rows("id string, slug string, display_name string, status string, created_at timestamp, updated_at timestamp",
         ("t", "tt", "T", "active", None, None), ("t", "tt", None, "odd", None, None), (None, None, "N", None, None, None)) \
        .write.parquet(str(tmp_path / "tenants"))
    rows("id string, tenant_id string, document_id string, principal_type string, principal_id string, "
         "permission string, created_at timestamp",
         ("1", "t", "d", "user", "u", "read", None), ("2", "x", "d", "user", "u", "read", None),
         ("3", None, "d", "user", "u", "write", None), ("3", "x", "d", "robot", "u", "read", None)) \
        .write.parquet(str(tmp_path / "acl"))
    made = audits.audit({"tenants": spark.read.parquet(str(tmp_path / "tenants")),
                         "document_acl": spark.read.parquet(str(tmp_path / "acl"))})
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 4
    got = {(r.table, r.rule): r.violations for r in made.collect()}
    assert {k: n for k, n in got.items() if n} == {
        ("tenants", "status_value"): 1, ("tenants", "display_name_not_null"): 1, ("tenants", "id_not_null"): 1,
        ("tenants", "slug_not_null"): 1, ("tenants", "status_not_null"): 1, ("tenants", "created_at_not_null"): 3,
        ("tenants", "updated_at_not_null"): 3, ("tenants", "unique_id"): 1, ("tenants", "unique_slug"): 1,
        ("document_acl", "principal_type_value"): 1, ("document_acl", "permission_value"): 1,
        ("document_acl", "tenant_id_not_null"): 1, ("document_acl", "created_at_not_null"): 4,
        ("document_acl", "unique_id"): 1, ("document_acl", "tenant_id_in_tenants"): 2}
    assert ("document_acl", "tenant_id_document_id_in_documents") not in got and got["tenants", "slug_shape"] == 0


def test_ids_of_different_parts_differ(rows):
    df = rows("a string, b string", ("x|y", "z"), ("x", "y|z"), ("x\\", "|y"), ("x", None), (None, "x"), ("x", ""), ("x", "\\0"))
    assert df.select(derived_id("a", "b")).distinct().count() == 7
