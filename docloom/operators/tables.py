"""Snapshot tables: upsert, tenant scope, life-cycle filters, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.ranking import ranked


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` to the declared columns; absent ones become typed nulls."""
    present = set(df.columns)
    fields = [part.split(" ", 1) for part in ddl.split(", ")]
    return df.selectExpr(*[
        f"CAST({name if name in present else 'NULL'} AS {kind}) AS {name}"
        for name, kind in fields
    ])


def last_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Last non-null value of each column per key.

    An aggregate, not a window: map-side partial results mean that a key holding a large share of
    the rows costs one row per input partition in the shuffle.
    """
    return df.groupBy(*keys).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ])


def upsert(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    as_of=None,
    insert: bool = False,
) -> DataFrame:
    """New snapshot of ``base`` with the non-null columns of ``changes`` laid over it.

    ``changes`` holds at most one row per key. ``updated_at`` moves to ``as_of`` (or to the value
    that ``changes`` gives) on changed rows only. With ``insert`` the keys that are new are added;
    they are found by an anti join on the unique key.
    """
    changed = [c for c in changes.columns if c not in keys]
    renamed = changes.select(*keys, *[F.col(c).alias(f"new_{c}") for c in changed],
                             F.lit(True).alias("is_changed"))
    joined = base.join(renamed, list(keys), "left")
    hit = F.col("is_changed").isNotNull()

    def column(name: str):
        if name in changed:
            return F.when(hit, F.coalesce(F.col(f"new_{name}"), F.col(name))) \
                .otherwise(F.col(name)).alias(name)
        if name == "updated_at" and as_of is not None:
            return F.when(hit, F.lit(as_of).cast("timestamp")).otherwise(F.col(name)).alias(name)
        return F.col(name)

    merged = joined.select(*[column(c) for c in base.columns])
    if not insert:
        return merged
    added = changes.join(base.select(*keys), list(keys), "left_anti")
    return merged.unionByName(added, allowMissingColumns=True)


def tenant_scope(df: DataFrame, tenant: str | None) -> DataFrame:
    """Rows of one tenant; without a tenant there are none. Prunes when laid out by tenant."""
    if tenant is None:
        return df.filter(F.lit(False))
    return df.filter(F.col("tenant_id") == tenant)


def session_scope(df: DataFrame, sessions: DataFrame, setting: str) -> DataFrame:
    """Rows each session sees, with its ``setting``: those of its tenant, none where it is null."""
    return df.join(sessions, F.col("tenant_id") == F.col(setting))


def outside_scope(df: DataFrame, tenant: str | None) -> DataFrame:
    """Rows a write under ``tenant`` must not contain (a null tenant is outside too)."""
    return df.filter(~F.col("tenant_id").eqNullSafe(F.lit(tenant)))


def live(df: DataFrame) -> DataFrame:
    """Rows that were not deleted; a table without the column has none deleted."""
    return df.filter(F.col("deleted_at").isNull()) if "deleted_at" in df.columns else df


def active(chunks: DataFrame) -> DataFrame:
    return live(chunks).filter("is_active")


def latest_versions(versions: DataFrame) -> DataFrame:
    """Latest live version per document.

    The rank filter lets Spark cut each map partition to one row per document before the shuffle.
    """
    newest = Window.partitionBy("tenant_id", "document_id").orderBy(
        F.desc("version_number"), F.desc("id"))
    return live(versions).withColumn("_rank", F.row_number().over(newest)) \
        .filter("_rank = 1").drop("_rank")


def number_versions(incoming: DataFrame, versions: DataFrame, order: str) -> DataFrame:
    """Give each incoming version the next number of its document.

    Numbers within a document follow ``order``, which is unique. One busy document is spread over
    all tasks: see ``operators/ranking.py``.
    """
    top = versions.groupBy("tenant_id", "document_id") \
        .agg(F.max("version_number").alias("_top"))
    numbered = ranked(incoming, ["tenant_id", "document_id"], [order], "_position")
    return numbered.join(top, ["tenant_id", "document_id"], "left") \
        .withColumn("version_number",
                    (F.coalesce("_top", F.lit(0)) + F.col("_position")).cast("int")) \
        .drop("_top", "_position")


def current_versions(documents: DataFrame, versions: DataFrame) -> DataFrame:
    """Each document with the version its pointer names, if any."""
    pointed = versions.select(
        "tenant_id",
        F.col("id").alias("current_version_id"),
        F.col("version_number").alias("current_version_number"),
        F.col("content_sha256").alias("current_content_sha256"),
    )
    return documents.join(pointed, ["tenant_id", "current_version_id"], "left")
