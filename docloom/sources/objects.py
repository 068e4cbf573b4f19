"""Source objects and derived artifacts."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.columns import sha256

OBJECT_COLUMNS = (
    "object_uri string, content binary, content_type string, content_sha256 string, "
    "tenant_id string"
)


def bucketed(df: DataFrame, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Store ``df`` at ``path`` in buckets by hash of ``key`` and return it as a table that knows so.

    A join on ``key`` then moves the other side only. Rows are dealt once, into one file a bucket;
    with ``dealt`` they lie by bucket already, as what is computed from a bucketed table does.
    ``buckets`` should be no fewer than the session's shuffle partitions.
    """
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key) \
        .option("path", path).saveAsTable(_table_name(path))
    return df.sparkSession.table(_table_name(path))


def open_bucketed(spark: SparkSession, path: str, ddl: str, key: str, buckets: int) -> DataFrame:
    """The same table in a session that did not write it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({ddl}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table_name(path))


def _table_name(path: str) -> str:
    return "docloom_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def land_bucketed(objects: DataFrame, path: str, buckets: int) -> DataFrame:
    """Objects with digests as a table bucketed by URI: one file a bucket, however many tenants."""
    return bucketed(objects.select(
        "object_uri", F.col("content").cast("binary").alias("content"), "content_type",
        sha256("content").alias("content_sha256"), "tenant_id"), path, "object_uri", buckets)


def land_objects(objects: DataFrame, path: str) -> None:
    """Append (tenant_id, object_uri, content, content_type) with digests, one folder per tenant.

    Map-only: each input partition writes its own files. A tenant with a third of the data is
    spread over as many files as it had input partitions.
    """
    objects.select(
        "object_uri", F.col("content").cast("binary").alias("content"), "content_type",
        sha256("content").alias("content_sha256"), "tenant_id",
    ).write.mode("append").partitionBy("tenant_id").parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OBJECT_COLUMNS).parquet(path)


def read_objects(
    spark: SparkSession, path: str, bucket: str, root: str, max_bytes: int | None = None
) -> DataFrame:
    """Files below ``path`` as objects of ``bucket``; ``root`` is the folder that stands for it.

    Files above the limit keep their row and size, and their content is null: the limit is pushed
    to the scan that reads content, so theirs is never read. The scan leaves out empty files: see
    ``with_empty_objects``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if max_bytes is not None:
        large = files.filter(F.col("length") > max_bytes) \
            .select("path", "modificationTime", "length", F.lit(None).cast("binary").alias("content"))
        files = files.filter(F.col("length") <= max_bytes).unionByName(large)
    prefix = root.rstrip("/") + "/"
    key = F.regexp_replace(
        F.substring_index("path", prefix, -1), "^/+", "")
    return files.select(
        F.concat(F.lit(f"s3://{bucket}/"), key).alias("object_uri"),
        "content", F.col("length").alias("byte_size"), F.col("modificationTime").alias("stored_at"))


def orphan_objects(objects: DataFrame, versions: DataFrame) -> DataFrame:
    """Objects no version names: what a failed or refused submission leaves to delete."""
    named = versions.select(F.col("source_object_uri").alias("object_uri"))
    return objects.join(named, "object_uri", "left_anti")


def missing_objects(versions: DataFrame, objects: DataFrame) -> DataFrame:
    """Versions whose object is not stored."""
    stored = objects.select(F.col("object_uri").alias("source_object_uri"))
    return versions.join(stored, "source_object_uri", "left_anti")


def write_artifacts(artifacts: DataFrame, path: str, batch: str = "batch=0") -> None:
    """(tenant_id, object_uri, body) rows of one batch; a batch run again replaces its own folder.

    A key is content-addressed and always carries the same body, so another batch may repeat it.
    """
    artifacts.select("object_uri", "body", "tenant_id") \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{batch}")


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Every key once. Keys are counted first; only rows of repeated ones are dealt and folded."""
    rows = spark.read.option("recursiveFileLookup", "true") \
        .schema("object_uri string, body string, tenant_id string").parquet(path)
    repeated = rows.groupBy("tenant_id", "object_uri").count().filter("count > 1").drop("count")
    if not repeated.take(1):
        return rows
    again = rows.join(repeated, ["tenant_id", "object_uri"], "left_semi")
    return rows.join(repeated, ["tenant_id", "object_uri"], "left_anti") \
        .unionByName(again.dropDuplicates(["tenant_id", "object_uri"]))


def write_points(points: DataFrame, path: str) -> None:
    """Point table with both vectors and the payload. Only tenants present in ``points`` are
    replaced, so an index projection can be rebuilt tenant by tenant."""
    points.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("tenant_id").parquet(path)
