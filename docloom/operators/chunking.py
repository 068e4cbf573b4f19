"""Chunks of document versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.columns import derived_id, sha256
from docloom.operators.tables import active, conform

TOKEN_BREAK = r"[ \t\r\n\f\x0b]+"


def tokens(text: str | Column) -> Column:
    """White-space tokens; empty for a blank text."""
    return F.filter(F.split(text, TOKEN_BREAK), lambda t: t != "")


def text_chunks(versions: DataFrame, max_tokens: int, overlap: int = 0) -> DataFrame:
    """Ordered windows of at most ``max_tokens`` tokens over the whole text of each version.

    ``versions``: tenant_id, document_version_id, text. The windows of a text are built in its own
    row and exploded, so there is no shuffle and the index starts at 0.
    """
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be at least 0 and below max_tokens")
    step = max_tokens - overlap
    count = F.size("_tokens")
    starts = F.when(count > 0, F.sequence(
        F.lit(0), F.greatest(count - 1 - overlap, F.lit(0)), F.lit(step)))
    windows = F.transform(starts, lambda s: F.struct(
        s.alias("first_token"),
        F.least(F.lit(max_tokens), count - s).alias("token_count"),
        F.array_join(F.slice("_tokens", s + 1, F.lit(max_tokens)), " ").alias("chunk_text"),
    ))
    return versions.withColumn("_tokens", tokens("text")) \
        .select("tenant_id", "document_version_id", F.posexplode(windows)
                .alias("chunk_index", "_w")) \
        .select("tenant_id", "document_version_id", "chunk_index", "_w.*")


def chunk_rows(
    pieces: DataFrame, *, as_of, strategy: str, model: str, model_version: str
) -> DataFrame:
    """Chunk table rows: digest, counts, anchor, ids that a re-run repeats."""
    chunk_id = derived_id("tenant_id", "document_version_id", "chunk_index", F.lit(strategy))
    anchor = F.array(F.concat(
        F.lit("tokens:"), F.col("first_token"), F.lit("-"),
        F.col("first_token") + F.col("token_count") - 1))
    return conform(pieces.select(
        chunk_id.alias("id"), "tenant_id", "document_version_id", "chunk_index",
        derived_id(F.lit("point"), chunk_id).alias("point_id"),
        sha256("chunk_text").alias("content_sha256"),
        anchor.alias("section_path"),
        "token_count",
        F.length("chunk_text").alias("character_count"),
        F.lit(True).alias("is_active"),
        F.lit(model).alias("embedding_model"),
        F.lit(model_version).alias("embedding_model_version"),
        F.lit(strategy).alias("chunking_strategy"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    ), schemas.TABLES["chunks"])


def reading_order(chunks: DataFrame) -> DataFrame:
    """Active chunks, version by version in reading order."""
    return active(chunks).orderBy("tenant_id", "document_version_id", "chunk_index")
