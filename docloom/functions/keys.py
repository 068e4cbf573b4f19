"""Object keys and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.columns import col, or_default


def source_object_key(tenant: str | Column, document: str | Column, name: str | Column) -> Column:
    """``tenant/document/original/name``; path separators in the name become underscores."""
    safe = or_default(F.translate(col(name), "/\\", "__"), "upload")
    return F.concat_ws("/", col(tenant), col(document), F.lit("original"), safe)


def artifact_key(
    tenant: str | Column, version: str | Column, digest: str | Column, name: str
) -> Column:
    return F.concat_ws(
        "/", col(tenant), col(version), F.lit("extracted"), col(digest), F.lit(name)
    )


def object_uri(bucket: str, key: str | Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), col(key))


# scheme, host, path; a query or fragment ends the path.
URI_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)/*([^?#]*)"


def uri_part(uri: str | Column, index: int) -> Column:
    return F.regexp_extract(col(uri), URI_PATTERN, index)


def object_key(uri: str | Column, bucket: str) -> Column:
    """Key of an object in ``bucket``, or null when the URI names no object there."""
    ours = (F.lower(uri_part(uri, 1)) == "s3") & (uri_part(uri, 2) == F.lit(bucket))
    return F.when(ours, F.nullif(uri_part(uri, 3), F.lit("")))


# Extension to declared type. Fixed values.
MIME_BY_EXTENSION = {
    "pdf": "application/pdf",
    "html": "text/html",
    "htm": "text/html",
    "txt": "text/plain",
    "csv": "text/csv",
    "json": "application/json",
    "xml": "text/xml",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "eml": "message/rfc822",
    "zip": "application/zip",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}


def guessed_mime(name: str | Column, default: str = "application/octet-stream") -> Column:
    """Declared type guessed from the file extension."""
    extension = F.lower(F.regexp_extract(col(name), r"\.([A-Za-z0-9]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension), F.lit(default))
