"""Token counts of huge documents by overlapping chunks that are spliced where they agree.

A text above ``chunk`` characters is encoded in chunks that overlap. Where both chunks of an overlap
begin a piece at the same character, and the left chunk is certain of it (see ``tokens.guard``), the
splitting of the whole text has a piece begin there too: the left chunk starts at a true split, so
all its splits before the guard are true, and splitting looks ahead only. Left of the point the left
chunk counts, right of it the right one. If an overlap holds no such point it is doubled, and a
right chunk that would start before the left one's last splice is encoded together with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm import tokens
from docloom.llm.words import text_slices

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 16_384
OVERLAP = 256
LIMIT = 1024


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text``, which is longer than ``chunk``; two chunks are held at a time."""
    def encoded(a: int, b: int):
        return tokenizer.encode(text[a:b], add_special_tokens=False)

    margin, step = tokens.guard(tokenizer), chunk - overlap
    start, end, ahead = 0, min(chunk, len(text)), step
    left = encoded(start, end)
    points, at = tokens.split_points(left)
    first = 0  # token of the left chunk at its splice
    total = 0
    while end < len(text):
        begin, stop, width = end - overlap, min(end + ahead, len(text)), overlap
        right, ahead = encoded(begin, stop), step
        while True:
            theirs, their_at = tokens.split_points(right)
            certain = points[(points + start >= begin) & (points + start <= end - margin) & (at >= first)] + start
            common = np.intersect1d(certain, theirs + begin)
            if len(common):
                splice = common[0]
                total += int(at[np.searchsorted(points, splice - start)]) - first
                first = int(their_at[np.searchsorted(theirs, splice - begin)])
                break
            width *= 2
            begin = end - width
            if begin <= start + (points[np.searchsorted(at, first)] if len(points) else 0):
                # Nothing certain is left to overlap with: both chunks become one, from the splice.
                begin = start + int(points[np.searchsorted(at, first)]) if len(points) else start
                # A stretch without splits grows by its own length, so it is encoded a few times only.
                first, ahead = 0, max(step, stop - begin)
                right = encoded(begin, stop)
                theirs, their_at = tokens.split_points(right)
                break
            right = encoded(begin, stop)
        start, end, left, points, at = begin, stop, right, theirs, their_at
    return total + len(left.ids) - first


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    Null and empty texts have no bytes and no tokens. Repeated rows are counted each; an empty table gives
    no rows. A very long text is counted chunk by chunk, in time linear in its length. Map only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.load(vocabulary)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), tokens.SLICE_BYTES):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
                short = [i for i, t in enumerate(texts) if len(t) <= chunk]
                counts = np.zeros(len(texts), np.int64)
                for i, e in zip(short, tokenizer.encode_batch_fast([texts[i] for i in short], add_special_tokens=False)):
                    counts[i] = len(e)
                for i, text in enumerate(texts):
                    if len(text) > chunk:
                        counts[i] = count_spliced(tokenizer, text, chunk, overlap)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[low:high], pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(counts), pa.array(counts > limit),
                ], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
