"""Plain-text views of HTML and JSON document trees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.columns import col, stripped

# The patterns stay inside the syntax that Java and RE2 share.
HIDDEN_BLOCKS = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>"
COMMENTS = r"(?s)<!--.*?-->"
TAGS = r"(?s)<[^>]*>"
SPACES = r"[ \t\r\n\f]+"


def html_text(html: str | Column) -> Column:
    """Visible text: scripts, styles, comments and tags out, white space folded."""
    shown = F.regexp_replace(col(html), HIDDEN_BLOCKS, " ")
    bare = F.regexp_replace(F.regexp_replace(shown, COMMENTS, " "), TAGS, " ")
    return F.btrim(F.regexp_replace(bare, SPACES, " "), F.lit(" "))


def tag_count(html: str | Column, tag: str) -> Column:
    return F.regexp_count(col(html), F.lit(rf"(?i)<{tag}\b")).cast("bigint")


def variant_member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def list_member(document: Column, name: str) -> Column:
    """Array member of a document tree; null when absent or not an array."""
    return F.try_variant_get(document, f"$.{name}", "array<variant>")


def list_size(document: Column, name: str) -> Column:
    return F.coalesce(F.size(list_member(document, name)), F.lit(0)).cast("bigint")


def _self_ref(figure: Column) -> Column:
    """Reference text: absent is empty, a null is the word None."""
    member = variant_member(figure, "self_ref")
    return F.when(member.isNull(), F.lit("")) \
        .when(F.is_variant_null(member), F.lit("None")) \
        .otherwise(F.try_variant_get(figure, "$.self_ref", "string"))


def figure_evidence(document: Column) -> Column:
    """Array of figure anchors of a document variant.

    Entries that are not objects are skipped and keep their place in the numbering. Members are
    in sorted order, as the artifact's JSON needs them.
    """
    empty = F.parse_json(F.lit("[]"))

    def evidence(figure: Column, index: Column) -> Column:
        record = F.struct(
            F.coalesce(variant_member(figure, "captions"), empty).alias("captions"),
            index.cast("bigint").alias("figure_index"),
            F.coalesce(variant_member(figure, "prov"), empty).alias("provenance"),
            _self_ref(figure).alias("self_ref"),
        )
        return F.when(F.schema_of_variant(figure).startswith("OBJECT"), record)

    figures = F.filter(F.transform(list_member(document, "pictures"), evidence),
                       lambda figure: figure.isNotNull())
    return F.coalesce(figures, F.array())


# Leading bytes to type, first match wins. Fixed values (published format signatures).
SIGNATURES = (
    (b"%PDF-", "application/pdf"),
    (b"\x89PNG\r\n\x1a\n", "image/png"),
    (b"\xff\xd8\xff", "image/jpeg"),
    (b"GIF8", "image/gif"),
    (b"II*\x00", "image/tiff"),
    (b"MM\x00*", "image/tiff"),
    (b"\x1f\x8b", "application/gzip"),
)
ZIP = b"PK\x03\x04"
# Folder inside an office container to its type. Fixed values.
OFFICE_FOLDERS = (
    (b"word/", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (b"xl/", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    (b"ppt/", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
)


def detected_type(content: str | Column) -> Column:
    """Type by content, never by name; text without markup is plain text."""
    data = col(content).cast("binary")

    def starts(prefix: bytes) -> Column:
        return F.substring(data, 1, len(prefix)) == F.lit(prefix)

    out = F.when(starts(SIGNATURES[0][0]), F.lit(SIGNATURES[0][1]))
    for prefix, kind in SIGNATURES[1:]:
        out = out.when(starts(prefix), F.lit(kind))
    for folder, kind in OFFICE_FOLDERS:
        out = out.when(starts(ZIP) & F.contains(data, F.lit(folder)), F.lit(kind))
    out = out.when(starts(ZIP), F.lit("application/zip"))
    head = F.lower(stripped(F.substring(data, 1, 256).cast("string")))
    out = out.when(head.startswith("<!doctype html") | head.startswith("<html"),
                   F.lit("text/html"))
    mail = F.substring(data, 1, 256).cast("string").rlike(
        r"^(From|To|Subject|Received|Return-Path|MIME-Version): ")
    return out.when(mail, F.lit("message/rfc822")).otherwise(F.lit("text/plain"))


# Kind of sensitive content to pattern, in the syntax Java and RE2 share.
SENSITIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "phone": r"\+?[0-9][0-9 ()-]{7,}[0-9]",
    "secret": r"(?i)(api[_-]?key|secret|password|token)[ ]*[=:]",
}


def sensitive_counts(text: str | Column) -> list[Column]:
    """Number of matches per kind of sensitive content."""
    return [F.regexp_count(col(text), F.lit(pattern)).cast("bigint").alias(kind)
            for kind, pattern in SENSITIVE.items()]
