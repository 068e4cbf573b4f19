"""Chunk, index and retrieval queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.functions.columns import derived_id
from docloom.operators import access, audits, chunking, lineage, retrieval, tables
from docloom.plans import governance
from docloom.plans import views as v
from docloom.plans.registry import query, uuid_sql
from docloom.plans.governance import ACL_SQL, CALLER, CALLER_SQL, TENANT
from docloom.session import scratch
from docloom.sources.objects import write_points

MAX_TOKENS, OVERLAP = 200, 20
STRATEGY, MODEL, MODEL_VERSION = "token-window", "given", "1"
TOP, PREFETCH = 5, 50


def versions_with_text(spark, sf):
    """Every document as version 1 of itself, whole text."""
    return v.text_table(spark, sf, "documents").select(
        F.col("source").alias("tenant_id"), F.col("doc_id").cast("string").alias("document_id"),
        derived_id("source", "doc_id", F.lit("version"), F.lit(1)).alias("document_version_id"),
        "text")


def chunks(spark, sf):
    pieces = chunking.text_chunks(versions_with_text(spark, sf), MAX_TOKENS, OVERLAP)
    return chunking.chunk_rows(pieces, as_of=v.AS_OF, strategy=STRATEGY, model=MODEL,
                               model_version=MODEL_VERSION)


_STEP = MAX_TOKENS - OVERLAP
_VERSION = uuid_sql("source", "doc_id", "'version'", "1")
_CHUNK = uuid_sql("tenant_id", "document_version_id", "chunk_index", f"'{STRATEGY}'")
PIECES_SQL = f"""
    SELECT doc_id, source AS tenant_id, {_VERSION} AS document_version_id, i AS chunk_index,
      i * {_STEP} AS first_token, least({MAX_TOKENS}, len(toks) - i * {_STEP}) AS token_count,
      array_to_string(toks[i * {_STEP} + 1 : i * {_STEP} + {MAX_TOKENS}], ' ') AS chunk_text
    FROM (SELECT *, unnest(range(0, CAST(greatest(len(toks) - 1 - {OVERLAP}, 0) // {_STEP} + 1
                                       AS BIGINT))) AS i
          FROM (SELECT doc_id, source, list_filter(string_split_regex(text, '[ \\t\\r\\n\\f\\x0b]+'),
                                                   lambda t: t <> '') AS toks FROM documents)
          WHERE len(toks) > 0)"""
CHUNKS_SQL = f"""
    SELECT *, {_CHUNK} AS id, {uuid_sql("'point'", _CHUNK)} AS point_id,
      sha256(chunk_text) AS content_sha256,
      'tokens:' || first_token || '-' || (first_token + token_count - 1) AS anchor
    FROM ({PIECES_SQL})"""


@query("chunk_documents", f"""
    SELECT id, document_version_id, CAST(chunk_index AS INTEGER) AS chunk_index, content_sha256,
      CAST(token_count AS INTEGER) AS token_count,
      CAST(length(chunk_text) AS INTEGER) AS character_count, anchor, point_id
    FROM ({CHUNKS_SQL})""")
def chunk_documents(spark, sf):
    return chunks(spark, sf).select(
        "id", "document_version_id", "chunk_index", "content_sha256", "token_count",
        "character_count", F.element_at("section_path", 1).alias("anchor"), "point_id")


@query("chunk_reading_order", f"""
    SELECT tenant_id, document_version_id, CAST(chunk_index AS INTEGER) AS chunk_index, id
    FROM ({CHUNKS_SQL})""")
def chunk_reading_order(spark, sf):
    return chunking.reading_order(chunks(spark, sf)).select(
        "tenant_id", "document_version_id", "chunk_index", "id")


@query("chunk_validity", """
    SELECT CAST(doc_id AS VARCHAR) AS id, concat_ws(',',
      CASE WHEN NOT n_chars > 500 THEN 'page_from_positive' END,
      CASE WHEN length(text) < n_chars OR doc_id % 50 = 0 THEN 'token_count_positive' END) AS broken
    FROM documents WHERE NOT n_chars > 500 OR length(text) < n_chars OR doc_id % 50 = 0""")
def chunk_validity(spark, sf):
    """The chunk rules over rows of which some are broken on purpose: short texts get page 0 and
    every fiftieth row no tokens."""
    rows = v.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("chunk_index"),
        F.sha2("text", 256).alias("content_sha256"),
        F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("page_from"),
        F.lit(None).cast("int").alias("page_to"),
        F.when((F.length("text") < F.col("n_chars")) | (F.col("doc_id") % 50 == 0), 0)
        .otherwise(1).alias("token_count"),
        F.lit(1).alias("character_count"))
    return audits.chunk_violations(rows).select("id", F.array_join("broken_rules", ",")
                                                .alias("broken"))


def index_tables(spark, sf):
    """Documents and versions that the payload join needs; some documents, and some versions of
    others, are deleted."""
    d = v.table(spark, sf, "documents")
    gone = F.lit(v.AS_OF).cast("timestamp")
    version_id = derived_id("source", "doc_id", F.lit("version"), F.lit(1))
    documents = d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("tenant_id"),
        F.lit("api").alias("source_system"),
        F.concat(F.lit("ext-"), "doc_id").alias("source_external_id"),
        F.concat(F.lit("Title "), "doc_id").alias("title"),
        F.when(F.col("lang") == "en", "internal").otherwise("restricted").alias("classification"),
        F.when(F.col("doc_id") % 23 == 0, gone).alias("deleted_at"))
    versions = d.select(
        version_id.alias("id"), F.col("source").alias("tenant_id"),
        F.col("doc_id").cast("string").alias("document_id"), F.lit(1).alias("version_number"),
        F.lit("text/plain").alias("mime_type"), F.col("lang").alias("language_code"),
        F.concat(F.lit(f"s3://{v.BUCKET}/"), "doc_id").alias("source_object_uri"),
        F.lit(None).cast("string").alias("normalized_object_uri"),
        F.when(F.col("doc_id") % 29 == 0, gone).alias("deleted_at"))
    return documents, versions


def payload(spark, sf):
    documents, versions = index_tables(spark, sf)
    made = chunks(spark, sf).withColumn("is_active", F.col("chunk_index") % 7 != 6)
    return retrieval.point_payload(
        made, versions, documents, governance.acl(spark, sf), v.AS_OF)


INDEXED_SQL = "doc_id % 23 <> 0 AND doc_id % 29 <> 0 AND chunk_index % 7 <> 6"
PAYLOAD_SQL = f"""
    SELECT c.point_id, c.tenant_id, CAST(c.doc_id AS VARCHAR) AS document_id,
      c.document_version_id, c.id AS chunk_id, 'text/plain' AS mime_type, d.lang AS language_code,
      CASE WHEN d.lang = 'en' THEN 'internal' ELSE 'restricted' END AS classification,
      array_to_string(a.principals, ',') AS acl_principals, c.content_sha256, c.anchor
    FROM ({CHUNKS_SQL}) c JOIN documents d USING (doc_id)
    JOIN (SELECT document_id, list_sort(list(DISTINCT principal)) AS principals
          FROM ({ACL_SQL}) GROUP BY 1) a ON a.document_id = CAST(c.doc_id AS VARCHAR)
    WHERE {INDEXED_SQL}"""


@query("point_payload", PAYLOAD_SQL)
def point_payload(spark, sf):
    return payload(spark, sf).select(
        "point_id", "tenant_id", "document_id", "document_version_id", "chunk_id", "mime_type",
        "language_code", "classification", F.array_join("acl_principals", ",")
        .alias("acl_principals"), "content_sha256",
        F.element_at("section_path", 1).alias("anchor"))


@query("retrieval_filter", f"""
    SELECT point_id, document_id FROM ({PAYLOAD_SQL})
    WHERE tenant_id = '{TENANT}' AND list_has_any(string_split(acl_principals, ','),
      [{CALLER_SQL}])""")
def retrieval_filter(spark, sf):
    return access.visible_points(payload(spark, sf), TENANT, CALLER) \
        .select("point_id", "document_id")


@query("provenance", f"""
    SELECT point_id, id AS chunk_id, document_version_id, CAST(doc_id AS VARCHAR) AS document_id,
      's3://{v.BUCKET}/' || doc_id AS source_object_uri, 'ext-' || doc_id AS source_external_id,
      anchor
    FROM ({CHUNKS_SQL})""")
def provenance(spark, sf):
    documents, versions = index_tables(spark, sf)
    made = chunks(spark, sf)
    return lineage.provenance(
        made.select("tenant_id", "point_id"), made, versions, documents).select(
        "point_id", "chunk_id", "document_version_id", "document_id", "source_object_uri",
        "source_external_id", F.element_at("section_path", 1).alias("anchor"))


@query("lineage_gaps", f"""
    SELECT 'points' AS "table", unnest(['tenant_id_not_null', 'document_id_not_null',
        'document_version_id_not_null', 'section_path_not_null', 'content_sha256_not_null',
        'embedding_model_not_null', 'label_not_null']) AS rule,
      unnest([0, 0, 0, 0, 0, 0, COUNT(*) FILTER (WHERE label IS NULL)]) AS violations
    FROM ({CHUNKS_SQL}) c LEFT JOIN embeddings ON vec_id = doc_id WHERE {INDEXED_SQL}""")
def lineage_gaps(spark, sf):
    """Nulls per lineage column of every point (of live documents and active chunks); the vector label is missing for some."""
    vectors = v.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("document_id"), "label")
    points = payload(spark, sf).join(vectors, "document_id", "left")
    return audits.lineage_gaps(points, [
        "tenant_id", "document_id", "document_version_id", "section_path", "content_sha256",
        "embedding_model", "label"])


@query("duplicate_effects", f"""
    SELECT 'chunks' AS "table", 'unique_document_version_id_chunk_index' AS rule,
      COUNT(*) - COUNT(DISTINCT (document_version_id, chunk_index)) AS violations
      FROM ({PIECES_SQL})
    UNION ALL SELECT 'points', 'unique_point_id', 0
    UNION ALL SELECT 'chunk_bodies', 'unique_tenant_id_content_sha256',
      COUNT(*) - COUNT(DISTINCT (tenant_id, sha256(chunk_text))) FROM ({PIECES_SQL})
    UNION ALL SELECT 'deliveries', 'unique_tenant_id_event_id',
      COUNT(*) - COUNT(DISTINCT (tenant_id, event_id)) FROM v_submitted""")
def duplicate_effects(spark, sf):
    made = chunks(spark, sf)
    return audits.duplicate_effects({
        "chunks": (made, ["document_version_id", "chunk_index"]),
        "points": (made, ["point_id"]),
        "chunk_bodies": (made, ["tenant_id", "content_sha256"]),
        "deliveries": (v.submitted(spark, sf), ["tenant_id", "event_id"]),
    })


@query("index_rebuild", f"""
    SELECT p.point_id, p.tenant_id, p.acl_principals, CAST(len(e.embedding) AS BIGINT)
        AS dimensions, COUNT(DISTINCT term) AS terms, COUNT(term) AS term_weight
    FROM ({PAYLOAD_SQL}) p JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = p.document_id
    LEFT JOIN (SELECT point_id, unnest(list_filter(string_split_regex(lower(chunk_text),
            '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS term FROM ({CHUNKS_SQL})) t
      ON t.point_id = p.point_id
    GROUP BY ALL""")
def index_rebuild(spark, sf):
    """Rebuild the point table from the tables (a document's vector serves all its chunks), one
    folder per tenant, and read it back."""
    pieces = chunking.text_chunks(versions_with_text(spark, sf), MAX_TOKENS, OVERLAP)
    chunk_id = derived_id("tenant_id", "document_version_id", "chunk_index", F.lit(STRATEGY))
    weights = pieces.select(derived_id(F.lit("point"), chunk_id).alias("point_id"),
                            retrieval.term_weights("chunk_text").alias("weights"))
    made = payload(spark, sf)
    dense = v.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("document_id"), "embedding")
    vectors = made.select("point_id", "document_id").join(dense, "document_id") \
        .join(weights, "point_id")
    path = scratch(spark, "points")
    write_points(retrieval.point_rows(made, vectors), path)
    stored = spark.read.schema(
        "point_id string, embedding array<float>, weights map<string,double>, "
        "acl_principals array<string>, tenant_id string").parquet(path)
    total = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, x: a + x)
    return stored.select(
        "point_id", "tenant_id", F.array_join("acl_principals", ",").alias("acl_principals"),
        F.size("embedding").cast("bigint").alias("dimensions"),
        F.size("weights").cast("bigint").alias("terms"), total.cast("bigint").alias("term_weight"))


# Search -----------------------------------------------------------------------------------------


def points(spark, sf):
    """Documents that have a vector, with their terms and access lists."""
    vectors = v.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding")
    texts = v.text_table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("tenant_id"), "text")
    lists = access.acl_principals(governance.acl(spark, sf)) \
        .withColumnRenamed("document_id", "point_id")
    return texts.join(vectors, "doc_id").select(
        F.col("doc_id").cast("string").alias("point_id"), "tenant_id", "embedding",
        retrieval.terms("text").alias("weights"), F.lit(True).alias("is_active"),
    ).join(lists, ["tenant_id", "point_id"], "left")


def centroids(spark, sf):
    """One query vector per label: the mean of its vectors."""
    places = v.table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("query_id"), F.posexplode("embedding"))
    means = places.groupBy("query_id", "pos").agg(
        F.round(F.avg(F.col("col").cast("double")), 6).alias("mean"))
    return means.groupBy("query_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda x: x["mean"])
        .alias("embedding"))


def term_queries(spark, sf):
    return v.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), retrieval.terms("text").alias("weights"))


def hybrid_queries(spark, sf):
    """Every benchmark text: its terms, and the mean vector of a label, dealt to the items in turn."""
    labels = v.table(spark, sf, "embeddings").select("label").distinct().count()
    in_turn = Window.orderBy("query_id")  # over the few labels
    means = centroids(spark, sf).select((F.row_number().over(in_turn) - 1).alias("turn"), "embedding")
    return term_queries(spark, sf).withColumn("turn", F.pmod("query_id", F.lit(max(1, labels))).cast("int")) \
        .join(means, "turn").drop("turn")


_DENSE = """
    centroid AS (
      SELECT query_id, list(mean ORDER BY pos) AS q FROM (
        SELECT label AS query_id, pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean
        FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
              FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
    dense_scores AS (
      SELECT query_id, CAST(vec_id AS VARCHAR) AS point_id,
        round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS score
      FROM embeddings, {queries})"""
_CENTROIDS = _DENSE.format(queries="centroid")
_IN_TURN = _DENSE.format(queries="""(
        SELECT item_id AS query_id, q FROM benchmark, (
          SELECT q, row_number() OVER (ORDER BY query_id) - 1 AS turn, COUNT(*) OVER () AS n FROM centroid)
        WHERE item_id % n = turn)""")
_TERMS = """
    doc_terms AS (
      SELECT point_id, term, COUNT(*) AS w FROM (
        SELECT {id} AS point_id, unnest(list_filter(string_split_regex(lower({text}),
          '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS term FROM {source}) GROUP BY 1, 2),
    query_terms AS (
      SELECT query_id, term, COUNT(*) AS w FROM (
        SELECT item_id AS query_id, unnest(list_filter(string_split_regex(lower(text),
          '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS term FROM benchmark) GROUP BY 1, 2),
    sparse_scores AS (
      SELECT query_id, point_id, CAST(SUM(d.w * q.w) AS DOUBLE) AS score
      FROM doc_terms d JOIN query_terms q USING (term) GROUP BY 1, 2)"""
_POINT_TERMS = _TERMS.format(
    id="CAST(doc_id AS VARCHAR)", text="text",
    source="documents WHERE doc_id IN (SELECT vec_id FROM embeddings)")
_CHUNK_TERMS = _TERMS.format(id="point_id", text="chunk_text", source=f"({CHUNKS_SQL})")


def _ranked(scores: str, k: int, where: str = "TRUE") -> str:
    return (f"SELECT query_id, point_id, score, row_number() OVER (PARTITION BY query_id "
            f"ORDER BY score DESC, point_id) AS rank FROM {scores} WHERE {where} "
            f"QUALIFY rank <= {k}")


def _fused(where: str) -> str:
    return f"""
    fused AS (
      SELECT query_id, point_id, round(SUM(1.0 / ({retrieval.RRF_K} + rank)), 9) AS score FROM (
        SELECT query_id, point_id, rank FROM ({_ranked('dense_scores', PREFETCH, where)})
        UNION ALL
        SELECT query_id, point_id, rank FROM ({_ranked('sparse_scores', PREFETCH, where)}))
      GROUP BY 1, 2)"""


_IN_DOCUMENTS = "point_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)"


def _out(df):
    return df.select("query_id", "point_id", F.round("score", 6).alias("score"), "rank")


@query("dense_topk", f"""
    WITH {_CENTROIDS}
    SELECT CAST(query_id AS BIGINT) AS query_id, point_id, round(score, 6) AS score, rank
    FROM ({_ranked('dense_scores', TOP)})""")
def dense_topk(spark, sf):
    vectors = v.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("point_id"), "embedding")
    return _out(retrieval.dense_topk(vectors, centroids(spark, sf), TOP))


@query("sparse_topk", f"""
    WITH {_CHUNK_TERMS}
    SELECT query_id, point_id, score, rank FROM ({_ranked('sparse_scores', TOP)})""")
def sparse_topk(spark, sf):
    """Every benchmark text against every chunk of every document."""
    pieces = chunking.text_chunks(versions_with_text(spark, sf), MAX_TOKENS, OVERLAP)
    chunk_id = derived_id("tenant_id", "document_version_id", "chunk_index", F.lit(STRATEGY))
    bodies = pieces.select(derived_id(F.lit("point"), chunk_id).alias("point_id"),
                           retrieval.terms("chunk_text").alias("weights"))
    return _out(retrieval.sparse_topk(bodies, term_queries(spark, sf), TOP))


@query("hybrid_rrf", f"""
    WITH {_IN_TURN}, {_POINT_TERMS}, {_fused(_IN_DOCUMENTS)}
    SELECT CAST(query_id AS BIGINT) AS query_id, point_id, round(score, 6) AS score, rank
    FROM ({_ranked('fused', TOP)})""")
def hybrid_rrf(spark, sf):
    return _out(retrieval.hybrid_topk(
        points(spark, sf), hybrid_queries(spark, sf), TOP, PREFETCH))


@query("filtered_hybrid", f"""
    WITH {_IN_TURN}, {_POINT_TERMS},
    visible AS (SELECT document_id FROM ({ACL_SQL}) WHERE tenant_id = '{TENANT}'
                AND principal IN ({CALLER_SQL})),
    {_fused('point_id IN (SELECT document_id FROM visible)')}
    SELECT CAST(query_id AS BIGINT) AS query_id, point_id, round(score, 6) AS score, rank
    FROM ({_ranked('fused', TOP)})""")
def filtered_hybrid(spark, sf):
    """The filter comes first: other tenants' points are never scored."""
    mine = access.visible_points(points(spark, sf), TENANT, CALLER)
    return _out(retrieval.hybrid_topk(mine, hybrid_queries(spark, sf), TOP, PREFETCH))


@query("active_chunk_count", f"""
    SELECT tenant_id, COUNT(*) AS chunks, CAST(SUM(token_count) AS BIGINT) AS tokens
    FROM ({PIECES_SQL}) GROUP BY 1""")
def active_chunk_count(spark, sf):
    return tables.active(chunks(spark, sf)).groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"))


@query("audit_all", governance.audit_sql(
    {t: sql.replace("{chunks}", CHUNKS_SQL) for t, sql in governance.AUDITED_SQL.items()}))
def audit_all(spark, sf):
    """Every declared rule of all nine tables with its count, zeros too."""
    return audits.audit(governance.audited_tables(spark, sf))
