"""Interaction audit of quality filters: what each removes in every order they can be applied in.

The documents that fail a filter are kept as sorted posting lists, one set of lists for each part
and range of doc_ids. What a filter removes after others is the difference of its list and the union
of theirs; all unions and differences of five lists are made by galloping merges, in which the
shorter list probes the longer. A range is worked on by itself, so only sizes are added up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import as_long, text_slices, word_bounds, word_hashes
from docloom.session import cut_lineage

FILTERS = "ABCDE"
REPEATED = FILTERS.index("E")
SPAN = 1 << 16  # documents whose ids make one range


class Limits(NamedTuple):
    """Failure conditions of the filters that look at one text; E needs the others."""
    min_words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10
    symbols: str = "#$%&*|"


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return np.diff(total[offsets])


def failures(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> np.ndarray:
    """Bits 0 to 3 of each text: which of the filters A to D it fails."""
    starts, ends, ranges = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    words = np.diff(ranges)
    distinct = np.zeros(len(words), np.int64)
    for i, (a, b) in enumerate(zip(ranges[:-1].tolist(), ranges[1:].tolist())):
        if b > a:
            own = np.sort(hashes[a:b])
            distinct[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    symbol = np.zeros(256, bool)
    symbol[list(limits.symbols.encode())] = True
    upper = _sums((data >= 65) & (data <= 90), offsets)
    points = _sums((data & 0xC0) != 0x80, offsets)
    failed = (words < limits.min_words, 100 * distinct < limits.distinct_percent * words,
              100 * upper > limits.upper_percent * points, _sums(symbol[data], offsets) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def flagged(docs: DataFrame, limits: Limits) -> DataFrame:
    """(doc_id, part, mask, d0, d1, n): equal rows counted, with filters A to D and the text's digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                raw = data.tobytes()
                digest = np.frombuffer(b"".join(
                    hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:])),
                    np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], batch.column(1)[low:high], pa.array(failures(data, offsets, limits), pa.int32()),
                     as_long(digest[:, 0]), as_long(digest[:, 1])], names=["doc_id", "part", "mask", "d0", "d1"])

    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text") \
        .mapInArrow(run, "doc_id bigint, part string, mask int, d0 bigint, d1 bigint") \
        .groupBy("doc_id", "part", "mask", "d0", "d1").agg(F.count("*").alias("n"))


def judged(docs: DataFrame, labels: DataFrame, limits: Limits) -> DataFrame:
    """(doc_id, part, tie, mask, n, good, toxic): every document with all five filters and its labels.

    Copies meet as one least id per text, so a text with many copies is one row a task; that id goes
    back to its own document alone. Rows without doc_id, which no key can match, are dealt by digest.
    """
    rows = cut_lineage(flagged(docs, limits))
    firsts = rows.groupBy("d0", "d1").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL") \
        .withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).withColumn("deal", F.lit(0).cast("bigint"))
    repeats = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return rows.join(firsts, ["doc_id", "d0", "d1"], "left") \
        .withColumn("deal", F.when(F.col("doc_id").isNull(), F.col("d0")).otherwise(F.lit(0))) \
        .join(marks, ["doc_id", "deal"], "left").select(
            "doc_id", "part", F.col("d0").alias("tie"),
            F.col("mask").bitwiseOR(F.when(repeats, 1 << REPEATED).otherwise(0)).alias("mask"), "n",
            F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def posting_lists(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per part and range of at most ``SPAN`` documents in order of their ids.

    part; ids: their doc_ids; rows: how often each stands in the table; failing: for each filter the
    sorted places, in ids, of the documents that fail it; good, toxic: of those labelled so.
    """
    names = ("mask", "good", "toxic", "n", "doc_id")

    def lists(part: str, rows: list[dict]) -> pa.RecordBatch:
        mask, good, toxic, n, ids = (pa.concat_arrays([r[c] for r in rows]) for c in names)
        mask, good, toxic = (x.to_numpy(zero_copy_only=False) for x in (mask, good, toxic))
        found = [np.flatnonzero(mask >> i & 1).astype(np.int32) for i in range(len(FILTERS))]
        return pa.RecordBatch.from_arrays([
            pa.array([part]), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, n)),
            pa.array([found], pa.list_(pa.list_(pa.int32()))),
            *(pa.array([np.flatnonzero(x).astype(np.int32)], pa.list_(pa.int32())) for x in (good, toxic))],
            names=["part", "ids", "rows", "failing", "good", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = None, [], 0
        for batch in batches:
            own = batch.column("part").to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)] if len(own) else []
            for low, high in zip([0, *cuts], cuts):
                while low < high:
                    if held and (own[low] != part or size == SPAN):
                        yield lists(part, held)
                        held, size = [], 0
                    part, stop = own[low], min(high, low + SPAN - size)
                    held.append({c: batch.column(c).slice(low, stop - low) for c in names})
                    size, low = size + stop - low, stop
        if held:
            yield lists(part, held)

    return judged(docs, labels, limits).repartitionByRange("part", "doc_id", "tie") \
        .sortWithinPartitions("part", "doc_id", "tie").mapInArrow(
            run, "part string, ids array<bigint>, rows array<bigint>, failing array<array<int>>, good array<int>, toxic array<int>")


# Merges of sorted lists --------------------------------------------------------------------------


def _met(probe: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each member of ``probe`` stands, or would, in ``held``, and whether it does."""
    at = np.searchsorted(held, probe)
    return at, held[np.minimum(at, len(held) - 1)] == probe if len(held) else np.zeros(len(probe), bool)


def union(lists: list[np.ndarray]) -> np.ndarray:
    """k-way union: each list, from the longest on, is merged in by probing what is there."""
    held, *rest = sorted(lists, key=len, reverse=True)
    for short in rest:
        at, there = _met(short, held)
        held = np.insert(held, at[~there], short[~there])
    return held


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members of ``a`` that are not in ``b``; the shorter of the two probes."""
    if len(b) < len(a):
        at, there = _met(b, a)
        return np.delete(a, at[there])
    return a[~_met(a, b)[1]]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    short, long = sorted((a, b), key=len)
    return short[_met(short, long)[1]]


# Sizes -------------------------------------------------------------------------------------------
# One number for every question about a part. For filter f after the set e of others: what f
# removes, and how many of these are good and toxic; then the size of each union, the number of
# documents, and each filter's sum over all orders.

SETS = 1 << len(FILTERS)
UNIONS = 3 * SETS * len(FILTERS)
TOTAL = UNIONS + SETS
SHAPLEY = TOTAL + 1
CELLS = SHAPLEY + len(FILTERS)


def cell(f: int, earlier: int) -> int:
    return 3 * (f * SETS + earlier)


def sizes(failing: list[np.ndarray], rows: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """All cells of one range."""
    out = np.zeros(CELLS, np.int64)
    out[TOTAL] = rows.sum()
    unions = [np.empty(0, np.int32)] * SETS
    for s in range(1, SETS):
        low = (s & -s).bit_length() - 1
        unions[s] = union([unions[s & (s - 1)], failing[low]])
        out[UNIONS + s] = rows[unions[s]].sum()
    for f, own in enumerate(failing):
        for s in range(SETS):
            if s >> f & 1:
                continue
            lost = difference(own, unions[s])
            at = cell(f, s)
            out[at:at + 3] = rows[lost].sum(), rows[common(lost, good)].sum(), rows[common(lost, toxic)].sum()
            k = bin(s).count("1")
            out[SHAPLEY + f] += factorial(k) * factorial(len(FILTERS) - 1 - k) * out[at]
    return out


def added_sizes(lists: DataFrame, parts_held: int = 1024) -> DataFrame:
    """(part, cells): every nonzero cell of a part, summed over its ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            found = [(p, np.flatnonzero(v)) for p, v in held.items()]
            return pa.RecordBatch.from_arrays([
                pa.array([p for p, at in found for _ in at], pa.string()),
                pa.array(np.concatenate([at for _, at in found]).astype(np.int32)),
                pa.array(np.concatenate([held[p][at] for p, at in found]))], names=["part", "cell", "value"])

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                rows, good, toxic = (batch.column(c)[i].values.to_numpy() for c in ("rows", "good", "toxic"))
                failing = [x.values.to_numpy() for x in batch.column("failing")[i].values]
                held[part] = held.get(part, 0) + sizes(failing, rows, good, toxic)
                if len(held) >= parts_held:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return lists.select("part", "rows", "failing", "good", "toxic") \
        .mapInArrow(run, "part string, cell int, value bigint") \
        .groupBy("part", "cell").agg(F.sum("value").alias("value")) \
        .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("cell", "value"))).alias("cells"))


def all_orders() -> str:
    """The 600 steps of all orders, as JSON: order, step, and the cells that answer for it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        earlier = 0
        for step, f in enumerate(order, 1):
            out.append({"o": "".join(FILTERS[i] for i in order), "s": step, "own": cell(f, 0), "at": cell(f, earlier),
                        "u": UNIONS + (earlier | 1 << f), "only": cell(f, SETS - 1 ^ 1 << f), "shapley": SHAPLEY + f})
            earlier |= 1 << f
    return json.dumps(out)


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs``: doc_id, text, lang; ``labels``: doc_id, quality, toxic; other columns are not read. A
    null text is empty (and equal to an empty one), a null lang is the part ''. Every row is a
    document: repeated rows count each, and do not fail E by each other, as no doc_id of theirs is
    smaller; a doc_id over different texts is several documents. A row without doc_id never fails E,
    makes nothing fail it and has no label. A doc_id labelled twice has a label if either row gives
    it. Texts are compared by 128-bit digests, words within a text by 64-bit ones; a very long text is
    read whole. An empty table has no parts and gives no rows.
    """
    value = {c: F.coalesce(F.col("cells")[F.col("x")[c]], F.lit(0).cast("bigint")) for c in ("own", "at", "u", "only", "shapley")}
    beside = {k: F.coalesce(F.col("cells")[F.col("x")["at"] + k], F.lit(0).cast("bigint")) for k in (1, 2)}
    steps = F.from_json(F.lit(all_orders()), "array<struct<o string, s int, own int, at int, u int, only int, shapley int>>")
    return added_sizes(posting_lists(docs, labels, limits)).select("part", "cells", F.explode(steps).alias("x")).select(
        "part", F.col("x")["o"].alias("filter_order"), F.col("x")["s"].alias("step"),
        (F.col("cells")[F.lit(TOTAL)] - value["u"]).alias("kept"), value["at"].alias("removed"),
        (value["own"] - value["at"]).alias("redundant"), value["only"].alias("unique_fails"),
        beside[1].alias("good_lost"), beside[2].alias("toxic_lost"), value["shapley"].alias("shapley"))
