"""Access control lists and the retrieval filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.tables import tenant_scope


def principal():
    return F.concat_ws(":", "principal_type", "principal_id")


def acl_principals(acl: DataFrame) -> DataFrame:
    """Sorted ``type:id`` principals per document. Repeats are dropped map-side, so what is
    gathered per document is exactly the list its payload holds."""
    distinct = acl.select("tenant_id", "document_id", principal().alias("principal")).distinct()
    return distinct.groupBy("tenant_id", "document_id").agg(
        F.sort_array(F.collect_list("principal")).alias("acl_principals"))


def readable_documents(
    documents: DataFrame,
    acl: DataFrame,
    principals: Sequence[str],
    permissions: Sequence[str] = ("read", "manage"),
) -> DataFrame:
    """Live documents that some of the caller's principals may read."""
    granted = acl.filter(F.col("permission").isin(*permissions) & principal().isin(*principals)) \
        .select("tenant_id", F.col("document_id").alias("id"))
    return documents.filter("deleted_at IS NULL").join(granted, ["tenant_id", "id"], "left_semi")


def visible_points(points: DataFrame, tenant: str | None, principals: Sequence[str]) -> DataFrame:
    """Points a caller may search: own tenant, active, and at least one shared principal."""
    caller = F.array(*[F.lit(p) for p in principals]).cast("array<string>")
    return tenant_scope(points, tenant).filter("is_active") \
        .filter(F.arrays_overlap("acl_principals", caller))
