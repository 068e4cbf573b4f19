"""Removal of repeated passages by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. Each window has a minimizer, the leftmost least hash of its
8-word sequences, so equal windows have equal minimizers, and neighbouring windows that share one form
a run. Runs are the documents' stream: those whose minimizer occurs once in the corpus hold nothing
repeated and leave at once, on narrow rows. Where a minimizer's runs are all alike, they are repeated
as they stand. For the rest, the distinct runs of a minimizer, with how often each occurs, are the
reference: shards of whole groups, bounded in words, become suffix automata whose states know whether
their strings occur twice or more. Each run is then streamed through its shard for matching
statistics, the longest string ending at each word that occurs elsewhere too; where that reaches the
threshold, a window is repeated. Maximal spans are the unions of these windows.

Automata of the whole corpus cannot be broadcast to all documents, so runs and reference are dealt by
minimizer, and each task has just the shard its runs can match. A minimizer with very many distinct
runs (the edges of a very common passage) is dealt by whole windows instead, which spread evenly.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import as_long, gram_hashes, mix, text_slices, word_bounds, word_hashes
from docloom.session import cut_lineage, scratch

WINDOW = 35
SEED = 8  # words of the sequences that minimizers are chosen from
SHARD_WORDS = 40_000
HOT_RUNS = 1000  # distinct runs of a minimizer above which it is dealt by windows


def least_positions(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least of every ``width`` consecutive values."""
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        reach += step
    return best


def runs(hashes: np.ndarray, ranges: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Text, first word, number of windows and minimizer of every run of the texts in ``ranges``."""
    grams = gram_hashes(hashes, SEED)
    counts = np.maximum(np.diff(ranges) - window + 1, 0)
    total = int(counts.sum())
    if not total:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(ranges[:-1], counts)
    at = least_positions(grams, window - SEED + 1)[start]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
    return text[first], start[first], np.diff(np.append(first, total)), grams[at[first]]


def run_hashes(hashes: np.ndarray, start: np.ndarray, windows: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hash of all words of each run."""
    power = np.full(len(hashes) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    back = np.full(len(hashes) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=total[1:])
    end = start + windows + window - 1
    return mix((total[end] - total[start]) * back[start] + windows.astype(np.uint64))


def text_key(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, ranges = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), ranges


class Automaton:
    """Suffix automaton of a sequence of symbols, with the weight of each state's positions."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]
        self.last = 0

    def extend(self, symbol: int, weight: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        self.weight.append(weight)
        p = self.last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                self.weight.append(0)
                while p >= 0 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def settle(self) -> None:
        """Add up weights from longer strings to their suffixes."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.weight[self.link[state]] += self.weight[state]
        self.weight[0] = 2

    def repeated(self, symbols: list[int]) -> list[int]:
        """Length of the longest string that ends at each symbol and has a weight of two or more."""
        nxt, link, length, weight = self.next, self.link, self.length, self.weight
        state = size = 0
        out = []
        for symbol in symbols:
            while state and symbol not in nxt[state]:
                state = link[state]
                size = length[state]
            if symbol in nxt[state]:
                state = nxt[state][symbol]
                size += 1
            while weight[state] < 2:
                state = link[state]
                size = length[state]
            out.append(size)
        return out


def shard_masks(reference: list[tuple[list[int], int]], window: int = WINDOW) -> list[int]:
    """For each (words, occurrences) of a shard, the windows that occur twice or more, as bits."""
    automaton = Automaton()
    for i, (words, n) in enumerate(reference):
        for word in words:
            automaton.extend(word, min(n, 2))
        automaton.extend(-1 - i, 0)  # nothing matches across runs
    automaton.settle()
    masks = []
    for words, _ in reference:
        mask = 0
        for i, size in enumerate(automaton.repeated(words)):
            if size >= window:
                mask |= 1 << (i - window + 1)
        masks.append(mask)
    return masks


def repeated_windows(docs: DataFrame, window: int = WINDOW, hot_runs: int = HOT_RUNS,
                     shard_words: int = SHARD_WORDS) -> DataFrame:
    """(tid, start, mask): for texts of ``docs`` (text), by ``text_key``, windows from word ``start``
    on that are repeated, as bits."""
    spark = docs.sparkSession

    def scan(column: pa.Array):
        for low, high, data, offsets in text_slices(column):
            hashes, ranges = hashed_words(data, offsets)
            text, start, windows, least = runs(hashes, ranges, window)
            yield data, offsets, ranges, text, start, windows, least, run_hashes(hashes, start, windows, window)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, least, own in scan(batch.column(0)):
                both = np.stack([least, own], axis=1)
                keys, n = np.unique(both, axis=0, return_counts=True) if len(both) else (both, np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [as_long(keys[:, 0]), as_long(keys[:, 1]), pa.array(n.astype(np.int64))], names=["m", "own", "n"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, ranges, text, start, windows, least, _ in scan(batch.column(0)):
                raw = data.tobytes()
                keys = [text_key(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                local = start - ranges[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()).take(pa.array(text)), as_long(least),
                     pa.array(local << 8 | windows)], names=["tid", "m", "run"])

    texts = docs.select("text")
    # The runs of a minimizer: how many, and how many different ones.
    shared = texts.mapInArrow(count, "m bigint, own bigint, n bigint") \
        .groupBy("m", "own").agg(F.sum("n").alias("n")) \
        .groupBy("m").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).filter("n > 1").select("m", "kinds")
    placed = cut_lineage(
        texts.mapInArrow(place, "tid binary, m bigint, run bigint").join(shared, "m")
        .groupBy("tid").agg(F.collect_set(F.struct("run", "kinds")).alias("runs")))
    alike = placed.select("tid", F.explode(F.filter("runs", lambda r: r["kinds"] == 1)["run"]).alias("run")) \
        .select("tid", F.shiftright("run", 8).alias("start"),
                (F.expr("shiftleft(1L, cast(run & 255 as int))") - 1).alias("mask"))
    open_runs = placed.select("tid", F.filter("runs", lambda r: r["kinds"] > 1).alias("runs")).filter("size(runs) > 0")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, z, own in zip(*(c.to_pylist() for c in batch.columns)):
                words = zlib.decompress(z).split()
                data = np.frombuffer(b" ".join(words), np.uint8)
                hashes, _ = hashed_words(data, np.array([0, len(data)]))
                start = np.array([r["run"] >> 8 for r in own], np.int64)
                windows = np.array([r["run"] & 255 for r in own], np.int64)
                hot = np.array([r["kinds"] > hot_runs for r in own])
                grams = gram_hashes(hashes, SEED)
                least = grams[least_positions(grams, window - SEED + 1)[start]]
                # A hot run falls into its windows, each a group by its own content.
                times = np.where(hot, windows, 1)
                inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                start, hot = np.repeat(start, times) + inner, np.repeat(hot, times)
                windows = np.where(hot, 1, np.repeat(windows, times))
                content = run_hashes(hashes, start, windows, window)
                group = np.where(hot, content, np.repeat(least, times))
                yield pa.RecordBatch.from_arrays([
                    as_long(group), as_long(content), pa.array([tid] * len(start), pa.binary()), pa.array(start),
                    pa.array([zlib.compress(b" ".join(words[a:a + n + window - 1]), 1)
                              for a, n in zip(start.tolist(), windows.tolist())], pa.binary()),
                ], names=["g", "own", "tid", "start", "z"])

    path = scratch(spark, "runs")
    keyed(docs, []).join(open_runs, "tid").select("tid", "z", "runs") \
        .mapInArrow(cut, "g bigint, own bigint, tid binary, start bigint, z binary").write.parquet(path)
    cuts = spark.read.parquet(path)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, int, list[int], int]] = []
        size, last = 0, None

        def done() -> pa.RecordBatch:
            masks = shard_masks([(words, n) for _, _, words, n in shard], window)
            return pa.RecordBatch.from_arrays(
                [pa.array([s[0] for s in shard], pa.int64()), pa.array([s[1] for s in shard], pa.int64()),
                 pa.array(masks, pa.int64())], names=["g", "own", "mask"])

        for batch in batches:
            for g, own, n, z in zip(*(c.to_pylist() for c in batch.columns)):
                if size > shard_words and g != last:
                    yield done()
                    shard, size = [], 0
                data = np.frombuffer(zlib.decompress(z), np.uint8)
                words = hashed_words(data, np.array([0, len(data)]))[0].tolist()
                shard.append((g, own, words, n))
                size += len(words)
                last = g
        if shard:
            yield done()

    masks = cuts.groupBy("g", "own").agg(F.count("*").alias("n"), F.first("z").alias("z")) \
        .repartition("g").sortWithinPartitions("g").select("g", "own", "n", "z") \
        .mapInArrow(judge, "g bigint, own bigint, mask bigint").filter("mask <> 0")
    return alike.unionByName(cuts.select("g", "own", "tid", "start").join(masks, ["g", "own"])
                             .select("tid", "start", "mask"))


def keyed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns, then tid and z: the key and the compressed text of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, packed = [], []
            for _, _, data, offsets in text_slices(batch.column(0)):
                raw = data.tobytes()
                for a, b in zip(offsets[:-1], offsets[1:]):
                    keys.append(text_key(raw[a:b]))
                    packed.append(zlib.compress(raw[a:b], 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                names=[*batch.schema.names[1:], "tid", "z"])

    named = [F.col(c).alias(f"__{i}") for i, c in enumerate(carried)]
    head = "".join(f"`__{i}` {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carried))
    return docs.select("text", *named).mapInArrow(run, head + "tid binary, z binary")


def covered(count: int, spans: list[dict], window: int = WINDOW) -> np.ndarray:
    """Which of ``count`` words a repeated window covers."""
    change = np.zeros(count + 1, np.int64)
    for span in spans:
        start, mask = span["start"], span["mask"]
        while mask:
            low = mask & -mask
            first = low.bit_length() - 1
            run = (~(mask >> first) & ((mask >> first) + 1)).bit_length() - 1  # ones from ``first`` on
            change[start + first] += 1
            change[start + first + run + window - 1] -= 1
            mask &= ~(((1 << run) - 1) << first)
    return np.cumsum(change[:count]) > 0


def without(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` without the marked words and the white space after each."""
    if not gone.any():
        return text
    data = np.frombuffer(text, np.uint8)
    starts, _, _ = word_bounds(data, np.array([0, len(data)]))
    bounds = [*starts.tolist(), len(text)]
    return text[:bounds[0]] + b"".join(text[a:b] for a, b, g in zip(bounds, bounds[1:], gone.tolist()) if not g)


def remove_repeated(docs: DataFrame, carried: tuple[str, ...] = ("doc_id",), keep_text: bool = False,
                    window: int = WINDOW, hot_runs: int = HOT_RUNS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``carried`` columns of every row of ``docs``, n_words, n_removed and kept_sha256, and with
    ``keep_text`` kept_text: the text without the removed words, its other white space as it was.

    A word goes if a window that covers it starts at any other place of the corpus with the same
    words, its own row and equal rows included. Null and empty texts have no words. Equal texts get
    equal results; doc_ids play no part. An empty table gives no rows.
    """
    spans = repeated_windows(docs, window, hot_runs, shard_words) \
        .groupBy("tid").agg(F.collect_set(F.struct("start", "mask")).alias("spans"))
    width = len(carried)
    joined = keyed(docs, list(carried)).join(spans, "tid", "left") \
        .select(*(f"__{i}" for i in range(width)), "z", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, removed, digest, kept = [], [], [], []
            for z, own in zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist()):
                text = zlib.decompress(z)
                every = text.split()
                gone = covered(len(every), own or [], window)
                left = [w for w, g in zip(every, gone.tolist()) if not g] if own else every
                words.append(len(every))
                removed.append(len(every) - len(left))
                digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
                if keep_text:
                    kept.append(without(text, gone).decode())
            made = [pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            made += [pa.array(kept, pa.string())] if keep_text else []
            names = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *made], names=[*(f"__{i}" for i in range(width)), *names])

    head = "".join(f"`__{i}` {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carried))
    out = joined.mapInArrow(run, head + "n_words bigint, n_removed bigint, kept_sha256 string"
                            + (", kept_text string" if keep_text else ""))
    return out.toDF(*carried, *out.columns[width:])
