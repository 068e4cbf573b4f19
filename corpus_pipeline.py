"""A training corpus in five stages, each over all rows the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import jaccard, langid, packing, pii, substrings
from docloom.llm.queries import fold
from docloom.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Rows carry whole texts through Python: two thousand at a time, some megabytes, and not ten."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but doc_id and text under names no operator uses, and the way back."""
    names = {f"__{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed({c: n for n, c in names.items()}), names


def with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns`` of ``docs`` with ``text`` as the new text; n_chars follows a changed text."""
    changed = ~F.col("text").eqNullSafe(F.col(text))
    made = {"text": F.col(text)}
    if "n_chars" in columns:
        made["n_chars"] = F.when(changed, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return docs.select(*(made.get(c, F.col(f"`{c}`")).alias(c) for c in columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that ``lang`` teaches; null and letterless texts go. Where no row
    teaches one, only these go."""
    small_batches(spark)
    model = langid.train(docs.filter(fold(4) != 2))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    hidden, names = shielded(docs)
    kept = langid.accepted(langid.identify(hidden, model))
    return kept.select(*hidden.columns).withColumnsRenamed(names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies; of rows with that doc_id in
    the group, the one whose text has the least digest. A doc_id over different texts stays with each
    that is in no other group. Rows without doc_id come last, and exact copies of them are one group
    too. An empty table stays empty."""
    small_batches(spark)
    keyed = docs.filter("doc_id IS NULL").take(1) or docs.groupBy("doc_id").count().filter("count > 1").take(1)
    if not keyed:
        found = jaccard.join(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("__id"))
        return docs.join(found, F.col("doc_id") == F.col("__id"), "left_anti")
    # Where doc_id is no key, rows get one, written with them so that it stays theirs.
    path = scratch(spark, "keyed")
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    groups = jaccard.join(rows.select(F.col("__row").alias("doc_id"), "text")) \
        .select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"), "n_shingles")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2("text", 256), "__row")
    # Texts without words are no near copies, yet exact copies without doc_id, or with one, are one.
    named = rows.join(groups, "__row").select("__row", order.alias("o"), F.when(F.col("n_shingles") > 0, F.struct(
        F.lit(None).cast("bigint").alias("d"), F.col("__group").alias("g"), F.lit(None).cast("string").alias("t"))).otherwise(
        F.struct(F.col("doc_id").alias("d"), F.lit(None).cast("bigint").alias("g"), F.sha2("text", 256).alias("t"))).alias("k"))
    kept = named.groupBy("k").agg(F.min("o").alias("o")).select(F.col("o.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").drop("__row")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that repeat. A text may become empty; a null one
    stays null. Every row is judged as it is, whatever its doc_id; an empty table stays empty."""
    small_batches(spark)
    hidden, names = shielded(docs)
    cut = substrings.remove_repeated(hidden.withColumn("__null", F.col("text").isNull()),
                                     carried=(*[c for c in hidden.columns if c != "text"], "__null"), keep_text=True)
    text = F.when(~F.col("__null"), F.col("kept_text"))
    changed = cut.withColumn("__new", text) \
        .withColumn("text", F.when(F.col("n_removed") == 0, F.col("__new")))
    return with_text(changed.select(*hidden.columns, "__new").withColumnsRenamed(names), docs.columns, "__new")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the name of its kind in place of each span of personal data. Null texts stay
    null; rows without doc_id and repeated rows are read like any other; an empty table stays empty."""
    small_batches(spark)
    hidden, names = shielded(docs)
    found = pii.find(hidden, pii.train(hidden), redact=True)
    made = found.withColumn("__new", F.when(F.col("text").isNotNull(), F.col("redacted")))
    return with_text(made.select(*hidden.columns, "__new").withColumnsRenamed(names), docs.columns, "__new")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place in it: see ``packing.pack`` for
    null texts, missing ids, ties and empty tables."""
    small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", passages),
    ("pii", personal_data),
    ("packing", packed),
]

# Neither automata nor boosted trees nor packing can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
