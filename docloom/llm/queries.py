"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(count: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``count``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % count


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every document."""
    from docloom.llm import langid

    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(fold(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


# The rule table of docloom.llm.quality, written out.
STOPS = """'the','of','and','to','in','that','is','it','for','was','le','la','les','de','des','et',
'en','un','une','que','der','die','das','und','den','von','zu','mit','ist','ein','el','los','las',
'y','se','del','por','con','una','para'"""

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
named AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM win),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM named) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(list_filter(ws, lambda x: x IN ({STOPS}))) AS BIGINT) AS n_stop_words,
        CAST(len(ls) AS BIGINT) AS n_lines
      FROM w LEFT JOIN cover ON w.doc_id = cover.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 20.0 * n_words
  AND n_symbols <= 0.3 * n_words AND n_stop_words >= 0.01 * n_words AND n_dup_lines <= 0.5 * n_lines AS kept
FROM f"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, the four base counts, base_failed, kept, n_stop_words, n_lines."""
    from docloom.llm.quality import quality

    return quality(documents(spark, sf_dir))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    from docloom.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    from docloom.llm.packing import pack

    return pack(documents(spark, sf_dir))


@query("op8_bpe_codec")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    from docloom.llm.bpe_codec import encode_decode

    return encode_decode(documents(spark, sf_dir))


@query("op9_pii_boosting")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, base counts, base_sha256, spans of every document."""
    from docloom.llm import pii

    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs))


@query("op6_toxicity_svm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, margin of every document."""
    from docloom.llm import toxicity

    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(fold(3) != 1)
    return toxicity.score(docs, toxicity.train(docs, labels)).select(
        "doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted", "margin")


@query("op2_threshold_topk", """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
d AS (SELECT vec_id, max(v) AS v FROM q GROUP BY vec_id),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM d a, d b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score of the 20 best rows for every vec_id divisible by 20."""
    from docloom.llm.topk import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    from docloom.llm.jaccard import join

    return join(documents(spark, sf_dir))


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    from docloom.llm.substrings import remove_repeated

    return remove_repeated(documents(spark, sf_dir))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
least_id AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > m THEN 16 ELSE 0 END) AS mask,
    coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM w JOIN least_id USING (t) LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic
  FROM f GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own,
    CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
s AS (SELECT part, filter_order, step, own,
    coalesce(SUM(n) FILTER (WHERE mask & (earlier | own) = 0), 0) AS kept,
    coalesce(SUM(n) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS removed,
    coalesce(SUM(n) FILTER (WHERE mask & own > 0 AND mask & earlier > 0), 0) AS redundant,
    coalesce(SUM(n) FILTER (WHERE mask = own), 0) AS unique_fails,
    coalesce(SUM(good) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS good_lost,
    coalesce(SUM(toxic) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS toxic_lost
  FROM h, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(SUM(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM s"""


@query("op11_filter_interactions", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, filter_order, step and the counts of every step of every order of five filters."""
    from docloom.llm.interactions import audit

    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


# Words of digits, letters and all beyond ASCII, lower-cased, as the last two operators take them.
PLAIN_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP12_SQL = f"""
WITH crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
  FROM range(0, 256) r(i))),
d AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS ws FROM documents),
dw AS (SELECT r, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({PLAIN_WORDS}) AS w FROM benchmark),
vocab AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
spelt AS (SELECT w, hex(encode(w)) AS x, CAST(octet_length(encode(w)) AS BIGINT) AS n FROM vocab),
bucketed AS (SELECT w, xor(list_reduce(list_transform(range(0, n), lambda k:
    (strpos('0123456789ABCDEF', x[2 * k + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * k + 2]) - 1),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelt, crc_table),
s AS (SELECT bucket, CAST(COUNT(*) AS DOUBLE) AS n FROM dw JOIN bucketed USING (w) GROUP BY 1),
t AS (SELECT bucket, CAST(COUNT(*) AS DOUBLE) AS n FROM bw JOIN bucketed USING (w) GROUP BY 1),
sizes AS (SELECT (SELECT CAST(COUNT(*) AS DOUBLE) FROM dw) AS s_all, (SELECT CAST(COUNT(*) AS DOUBLE) FROM bw) AS t_all),
gain AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * (s_all + 10000) / ((s.n + 1) * (t_all + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket), sizes),
weighed AS (SELECT r, COUNT(*) AS n_features, CAST(SUM(g) AS BIGINT) AS weight
  FROM dw JOIN bucketed USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(ws) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5)
      / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY fit AND score IS NOT NULL ORDER BY score DESC, doc_id, n_features, weight) AS place,
    COUNT(*) FILTER (WHERE fit) OVER () * 10 // 100 AS take FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN fit AND score IS NOT NULL AND place <= take THEN place END AS rank FROM placed"""


@query("op12_target_resampling", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it was not drawn."""
    from docloom.llm.resampling import resample

    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = f"""
WITH b AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {PLAIN_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
d AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS ws FROM documents),
dw AS (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(range(1, CAST(len(ws) AS BIGINT) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM b) WHERE len(ws) >= n)),
m AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT r, COUNT(DISTINCT w) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS w FROM m) GROUP BY r),
item AS (SELECT r, COUNT(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""


@query("op13_decontamination", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    from docloom.llm.decontamination import decontaminate

    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the five stages of ``corpus_pipeline`` pack."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
