"""Importance resampling towards a target: hashed word features weigh documents, Gumbel keys draw.

A feature is a run of words and its bucket the CRC-32 of its bytes. The vocabulary has a head and a
tail: CRC states of frequent words, and buckets of frequent pairs, are broadcast in tables of fixed
size; words of the tail take their CRC from their bytes, and runs join the states of their words. Head
and tail give the same numbers, so totals are exact whatever the head holds: it only saves work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.crc import Joiner, crc_of
from docloom.llm.words import (
    LOWER, PUNCTUATION, as_long, gram_hashes, ship, shipped, text_slices, word_bounds, word_hashes,
)
from docloom.operators.ranking import ranked
from docloom.session import cut_lineage

BUCKETS = 10_000
HEAD_DOCS = 2_000  # about so many rows choose the head
HEAD = 1 << 16  # words, and as many pairs, of the head
SLOTS = 1 << 18  # places of a head table; of two entries in one place the more frequent stays


class Head(NamedTuple):
    """Two tables by the low bits of a 64-bit hash: words to CRC states, pairs to buckets."""
    words: np.ndarray
    states: np.ndarray
    pairs: np.ndarray
    buckets: np.ndarray


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries, the more frequent later, each in its place."""
    held, found = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint32)
    place = keys & np.uint64(SLOTS - 1)
    held[place], found[place] = keys, values
    return held, found


def _known(keys: np.ndarray, held: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = keys & np.uint64(SLOTS - 1)
    return found[place], held[place] == keys


class Features:
    """Buckets of all runs of up to ``longest`` words of the texts of a slice."""

    def __init__(self, head: Head, longest: int, buckets: int) -> None:
        self.head, self.longest, self.buckets, self.join = head, longest, buckets, Joiner()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words per text, and for each length of run (text, bucket) of its features."""
        data = LOWER[data]
        starts, ends, ranges = word_bounds(data, offsets, PUNCTUATION)
        words = np.diff(ranges)
        owner = np.repeat(np.arange(len(words)), words)
        hashes = word_hashes(data, starts, ends)
        state, known = _known(hashes, self.head.words, self.head.states)
        tail = np.flatnonzero(~known)
        state = state.copy()
        state[tail] = crc_of(data, starts[tail], ends[tail])
        out = [(owner, (state % np.uint32(self.buckets)).astype(np.int64))]
        run, length = state, ends - starts
        space = np.full(len(starts), crc_of(np.array([32], np.uint8), np.array([0]), np.array([1]))[0], np.uint32)
        for size in range(2, self.longest + 1):
            count = max(len(starts) - size + 1, 0)
            whole = np.flatnonzero(owner[:count] == owner[size - 1:])
            bucket = np.zeros(len(whole), np.uint32)
            missing = np.ones(len(whole), bool)
            if size == 2:
                bucket, there = _known(gram_hashes(hashes, 2)[whole], self.head.pairs, self.head.buckets)
                missing, bucket = ~there, bucket.copy()
            if size == 2 and self.longest == 2:
                rest = whole[missing]
            else:  # longer runs go on from the state of every shorter one
                rest = whole
            gap = self.join(run[rest], space[:len(rest)], np.ones(len(rest), np.int64))
            last = rest + size - 1
            joined = self.join(gap, state[last], length[last])
            found = joined % np.uint32(self.buckets)
            if len(rest) == len(whole):
                bucket = found
                run = np.zeros(len(starts), np.uint32)
                run[rest] = joined
            else:
                bucket[missing] = found
            out.append((owner[whole], bucket.astype(np.int64)))
        return words, out


def _empty_head() -> Head:
    return Head(*_table(np.empty(0, np.uint64), np.empty(0, np.uint32)), *_table(np.empty(0, np.uint64), np.empty(0, np.uint32)))


def learn_head(docs: DataFrame, longest: int, buckets: int) -> Head:
    """The head, from about ``HEAD_DOCS`` rows drawn by hash. No result depends on the draw."""
    total = docs.count()
    step = max(1, total // HEAD_DOCS)
    some = docs.select("text", F.xxhash64("doc_id", F.lit(12)).alias("x")).filter(F.pmod("x", F.lit(step)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                data = LOWER[data]
                starts, ends, ranges = word_bounds(data, offsets, PUNCTUATION)
                hashes = word_hashes(data, starts, ends)
                key, first, n = np.unique(hashes, return_index=True, return_counts=True)
                kinds, keys = [np.ones(len(key), np.int32)], [key]
                values, counts = [crc_of(data, starts[first], ends[first])], [n]
                if longest > 1 and len(hashes) > 1:
                    owner = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
                    whole = np.flatnonzero(owner[:-1] == owner[1:])
                    key, first, n = np.unique(gram_hashes(hashes, 2)[whole], return_index=True, return_counts=True)
                    a = whole[first]
                    join, one = Joiner(), np.array([32], np.uint8)
                    space = np.full(len(a), crc_of(one, np.array([0]), np.array([1]))[0], np.uint32)
                    left = join(crc_of(data, starts[a], ends[a]), space, np.ones(len(a), np.int64))
                    both = join(left, crc_of(data, starts[a + 1], ends[a + 1]), ends[a + 1] - starts[a + 1])
                    kinds.append(np.full(len(a), 2, np.int32))
                    keys.append(key)
                    values.append(both % np.uint32(buckets))
                    counts.append(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(kinds)), as_long(np.concatenate(keys)),
                    pa.array(np.concatenate(values).astype(np.int64)), pa.array(np.concatenate(counts).astype(np.int64))],
                    names=["kind", "key", "value", "n"])

    found = some.mapInArrow(run, "kind int, key bigint, value bigint, n bigint") \
        .groupBy("kind", "key").agg(F.first("value").alias("value"), F.sum("n").alias("n"))
    tables = []
    for kind in (1, 2):
        if kind > longest:
            tables += _table(np.empty(0, np.uint64), np.empty(0, np.uint32))
            continue
        rows = found.filter(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(HEAD).select("key", "value").toPandas()[::-1]
        tables += _table(rows["key"].to_numpy(np.int64).copy().view(np.uint64), rows["value"].to_numpy().astype(np.uint32))
    return Head(*tables)


def bucket_totals(docs: DataFrame, head, longest: int, buckets: int) -> np.ndarray:
    """Features of all rows in each bucket: one array per task, then a sum; ``buckets`` numbers at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(shipped(head), longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                for _, bucket in features(data, offsets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of target to source in each bucket, in thousandths, with one added to every count."""
    s_all, t_all, size = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, head, gain, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, worth = Features(shipped(head), longest, buckets), shipped(gain)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                words, runs = features(data, offsets)
                count, weight = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
                for owner, bucket in runs:
                    bounds = np.searchsorted(owner, np.arange(len(words) + 1))
                    total = np.append(0, np.cumsum(worth[bucket]))
                    count += np.diff(bounds)
                    weight += np.diff(total[bounds])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array(words.astype(np.int64)), pa.array(count), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, min_words: int = 20,
             percent: int = 10, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text).

    ``target`` needs a text column; other columns are not read. Null and empty texts have no features
    and weight 0. Every row counts: repeated rows weigh the same and stand one after the other; rows
    with equal score and doc_id stand by their features. A row without doc_id has no key, so its score
    and rank are null, though its features count and it is one of the documents a share is drawn of. A
    very long text is weighed whole. Of an empty target all gains follow from the source; an empty
    ``docs`` gives no rows.
    """
    spark = docs.sparkSession
    head = ship(spark, learn_head(docs, longest, buckets))
    source = bucket_totals(docs, head, longest, buckets)
    gain = ship(spark, gains(source, bucket_totals(target, head, longest, buckets)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    key = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = cut_lineage(weighed(docs, head, gain, longest, buckets)
                       .withColumn("score", (F.col("weight") + key).cast("bigint"))
                       .withColumn("fit", F.col("n_words") >= min_words))
    take = (rows.filter("fit").count() * percent) // 100
    order = [F.desc(F.col("fit") & F.col("score").isNotNull()), F.desc("score"), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    placed = ranked(rows, [], order, "place")
    drawn = F.col("fit") & F.col("score").isNotNull() & (F.col("place") <= take)
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))
