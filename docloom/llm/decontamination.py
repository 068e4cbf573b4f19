"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the test items.

Words of items and documents are lower-cased and numbered alike; the automaton reads word numbers, so
a match is a run of words, and every word knows the place in the original text it came from. A text is
read once; of it the automaton sees only the runs of words that items use at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.tokens import per_worker
from docloom.llm.words import LOWER, PUNCTUATION, ship, shipped, text_slices, word_bounds, word_hashes
from docloom.session import cut_lineage

WINDOW = 10
SHARD_WINDOWS = 1 << 17  # windows of one automaton: at ten words each about 100 MB
STEP = 1 << 14  # windows of a very long item at a time
BITS = 22  # of the filter that most words outside the items fail
HIT = "struct<word: int, start: int, end: int>"


class Patterns(NamedTuple):
    """Distinct windows and the items that hold each."""
    key: str
    windows: list[str]
    items: list[str]
    bounds: np.ndarray  # of each window's items in ``members``
    members: np.ndarray


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(window, item): distinct windows of all items; an item of fewer words, but not none, is one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in text_slices(batch.column(1), 1 << 18):
                data = LOWER[data]
                raw = data.tobytes()
                starts, ends, ranges = word_bounds(data, offsets, PUNCTUATION)
                for i, (a, b) in enumerate(zip(ranges[:-1].tolist(), ranges[1:].tolist())):
                    item = batch.column(0)[low + i].as_py()
                    last = max(b - size, a)  # where the last window begins
                    for j in range(a, last + 1 if b > a else a, STEP):
                        words = [raw[s:e].decode() for s, e in zip(starts[j:min(j + STEP + size, b)].tolist(), ends[j:min(j + STEP + size, b)].tolist())]
                        made = sorted({" ".join(words[k:k + size]) for k in range(min(STEP, last + 1 - j))})
                        yield pa.RecordBatch.from_arrays([pa.array(made), pa.array([item] * len(made), pa.string())], names=["window", "item"])

    return items.select(F.col("item_id").cast("string").alias("item"), "text") \
        .mapInArrow(run, "window string, item string").distinct()


def shards(windows: DataFrame, most: int = SHARD_WINDOWS) -> Iterator[Patterns]:
    """All (window, item) rows, about ``most`` at a time: a benchmark of any size is several automata."""
    count = max(1, -(-windows.count() // most))
    for i in range(count):
        rows = windows.filter(F.pmod(F.xxhash64("window", "item"), F.lit(count)) == i).orderBy("window", "item").collect()
        items = sorted({r["item"] for r in rows if r["item"] is not None})
        place = {item: at for at, item in enumerate(items)}
        texts, bounds, members = [], [], []
        for window, item in rows:
            if not texts or texts[-1] != window:
                texts.append(window)
                bounds.append(len(members))
            if item is not None:
                members.append(place[item])
        yield Patterns(uuid.uuid4().hex, texts, items, np.array([*bounds, len(members)]), np.array(members, np.int64))


class Matcher:
    """The automaton, made once in a worker."""

    def __init__(self, patterns: Patterns) -> None:
        import ahocorasick

        self.patterns = patterns
        split = [w.split(" ") for w in patterns.windows]
        words = sorted({w for window in split for w in window})
        data = np.frombuffer("".join(words).encode(), np.uint8)
        sizes = np.array([len(w.encode()) for w in words], np.int64)
        ends = np.cumsum(sizes)
        hashes = word_hashes(data, ends - sizes, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = dict(zip((words[i] for i in order.tolist()), range(len(words))))
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[self.hashes & np.uint64((1 << BITS) - 1)] = True
        self.length = np.array([len(window) for window in split], np.int64)
        self.least = int(self.length.min()) if split else 0
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i, window in enumerate(split):
            self.automaton.add_word(tuple(number[w] for w in window), i)
        self.automaton.make_automaton()

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for a word no item has."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[hashes & np.uint64((1 << BITS) - 1)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        there = self.hashes[at] == hashes[maybe]
        out[maybe[there]] = at[there]
        return out

    def matches(self, hashes: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence in texts that are ``ranges`` of the words."""
        if not self.least:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        number = self.numbers(hashes)
        inside = number >= 0
        first = np.zeros(len(number) + 1, bool)
        first[ranges] = True
        starts = np.flatnonzero(inside & (~np.append(False, inside[:-1]) | first[:-1]))
        ends = np.flatnonzero(inside & (~np.append(inside[1:], False) | first[1:])) + 1
        long = ends - starts >= self.least
        last, found = [], []
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            for end, window in self.automaton.iter(tuple(number[a:b].tolist())):
                last.append(a + end)
                found.append(window)
        found = np.array(found, np.int64)
        return np.array(last, np.int64) - self.length[found] + 1, found

    def items_of(self, windows: np.ndarray) -> list[str]:
        bounds, members = self.patterns.bounds, self.patterns.members
        found = np.unique(np.concatenate([members[bounds[w]:bounds[w + 1]] for w in np.unique(windows).tolist()]))
        return [self.patterns.items[i] for i in found.tolist()]


def _scan(docs: DataFrame, patterns: Patterns) -> DataFrame:
    """(row, doc_id, n_words, items, hits) of every row by one automaton."""
    parts = ship(docs.sparkSession, patterns)
    key = patterns.key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = per_worker(("automaton",), dict)
        if key not in held:  # a worker keeps the last automaton only
            held.clear()
            held[key] = Matcher(shipped(parts))
        matcher = held[key]
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                lower = LOWER[data]
                starts, ends, ranges = word_bounds(lower, offsets, PUNCTUATION)
                at, window = matcher.matches(word_hashes(lower, starts, ends), ranges)
                items: list[list[str]] = [[] for _ in range(high - low)]
                step = np.zeros(len(starts) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + matcher.length[window], -1)
                hit = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                owner = np.searchsorted(ranges, at, side="right") - 1
                order = np.argsort(owner, kind="stable")
                cuts = np.flatnonzero(np.diff(owner[order])) + 1
                for part in np.split(order, cuts):
                    if len(part):
                        items[owner[part[0]]] = matcher.items_of(window[part])
                bounds = np.searchsorted(hit, ranges)
                # Code points before each byte lead back to the original text; lower-casing keeps bytes.
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80)) if len(hit) else np.zeros(1, np.int64)
                text = np.repeat(np.arange(high - low), np.diff(bounds))
                begin = points[offsets[text]] if len(hit) else np.empty(0, np.int64)
                hits = pa.StructArray.from_arrays(
                    [pa.array((hit - ranges[text]).astype(np.int32)),
                     *(pa.array((points[x[hit]] - begin).astype(np.int32)) for x in (starts, ends))],
                    names=["word", "start", "end"])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i)[low:high] for i in (0, 1)), pa.array(np.diff(ranges).astype(np.int64)),
                    pa.array(items, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), hits)],
                    names=["row", "doc_id", "n_words", "items", "hits"])

    return docs.mapInArrow(run, f"row bigint, doc_id bigint, n_words bigint, items array<string>, hits array<{HIT}>")


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = SHARD_WINDOWS) -> DataFrame:
    """doc_id, n_words, items, hits of every row of ``docs`` (doc_id, text).

    items: ids, sorted as strings, of the items of ``benchmark`` (item_id, text) of which a window
    occurs; hits: number and place (code points of the original text, end exclusive) of each word in
    an occurrence. Null and empty texts have no words and no hits, on either side; empty tables give
    no rows, or no hits. Repeated rows, doc_ids and items are worked on as they are, equal item_ids
    as one item; an item without id hits but is not listed. Other columns are not read. A very long
    text is read whole. Words are compared by 64-bit hashes.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    scans = [_scan(rows, p) for p in shards(cut_lineage(windows_of(benchmark, size)), most)]
    if len(scans) == 1:
        return scans[0].drop("row")
    # Beyond one automaton: one pass each, of which only rows with hits reach the shuffle twice.
    every = scans[0]
    for scan in scans[1:]:
        every = every.unionByName(scan.filter(F.size("hits") > 0))
    return every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits")).drop("row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = SHARD_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row: see ``matches``."""
    return matches(docs, benchmark, size, most).select(
        "doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
