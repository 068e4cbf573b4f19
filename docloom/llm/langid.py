"""Language identification by prediction by partial matching (PPM).

For each language, byte contexts of order 0 to ``order`` with the counts of the bytes that followed
them form a variable-order context tree. A byte is coded in the longest context the language has
seen; where the context never saw that byte, an escape (method C: a context of N bytes and T
distinct ones escapes with probability T / (N + T)) leads to the next shorter one and at last to
256 equally likely bytes. Escapes exclude nothing, so the code lengths are exact for a decodable
code and add up per context. The language with the shortest code wins. Statistics are frozen: a
text never changes them.

Training is one scan over a bounded sample and a count per (language, order, gram); the model holds
a row per distinct gram of that sample and so has the sample's bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import LOWER, mix, ship, shipped, text_slices

ORDER = 4
SAMPLE_DOCS = 400  # expected sample rows of one language
UNDETERMINED = "und"
SLICE_BYTES = 1 << 18  # of text coded at once: a byte takes over a hundred on the way
RAW_BITS = 8.0  # a code as long as the bytes themselves has recognised nothing

_FOLD = LOWER.copy()
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def folded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with every run of other ASCII as one space, ``order`` spaces ahead of each
    text; the position of each scored byte; the range of scored bytes of each text."""
    folded_bytes = _FOLD[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (folded_bytes[1:] != 32) | (folded_bytes[:-1] != 32)
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    keep[firsts] = True
    # A leading space repeats the padding.
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[starts] &= folded_bytes[starts] != 32
    kept = np.flatnonzero(keep)
    ranges = np.searchsorted(kept, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(ranges))
    at = np.arange(len(kept)) + order * (owner + 1)
    out = np.full(len(kept) + order * (len(offsets) - 1), 32, np.uint8)
    out[at] = folded_bytes[kept]
    return out, at, ranges


def grams(padded: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes up to and with each position, as one number."""
    out = np.zeros(len(at), np.uint64)
    for back in range(length - 1, -1, -1):
        out = (out << np.uint64(8)) | padded[at - back]
    return out


class Table(NamedTuple):
    """Open addressing from gram to row; -1 marks an empty slot."""
    slots: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> Table:
        size = 1 << max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        slots = np.full(size, -1, np.int32)
        rows = np.arange(len(keys), dtype=np.int32)
        place = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
        while len(rows):
            free = slots[place] < 0
            slots[place[free]] = rows[free]
            rest = slots[place] != rows
            rows, place = rows[rest], (place[rest] + 1) & (size - 1)
        return cls(slots, keys)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each gram, -1 where the table lacks it."""
        out = np.full(len(wanted), -1, np.int32)
        todo = np.arange(len(wanted))
        place = (mix(wanted) & np.uint64(len(self.slots) - 1)).astype(np.int64)
        while len(todo) and len(self.keys):
            rows = self.slots[place]
            used = rows >= 0
            todo, place, rows = todo[used], place[used], rows[used]
            same = self.keys[rows] == wanted[todo]
            out[todo[same]] = rows[same]
            todo, place = todo[~same], (place[~same] + 1) & (len(self.slots) - 1)
        return out


class Model(NamedTuple):
    """Code lengths in bits, a column per language. ``symbols[k]``: of a byte after k bytes, with
    the escapes that lead to it; ``escapes[k]``: of leaving a context of k bytes."""
    languages: list[str]
    order: int
    symbols: list[tuple[Table, np.ndarray]]
    escapes: list[tuple[Table, np.ndarray]]

    def lengths(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of each byte in each language."""
        out = np.zeros((len(at), len(self.languages)), np.float32)
        todo = np.arange(len(at))
        for k in range(self.order, -1, -1):
            grams_k = grams(padded, at[todo], k + 1)
            table, bits = self.symbols[k]
            rows = table.find(grams_k)
            hit = rows >= 0
            out[todo[hit]] += bits[rows[hit]]
            todo, grams_k = todo[~hit], grams_k[~hit]
            if not len(todo):
                return out
            table, bits = self.escapes[k]
            rows = table.find(grams_k >> np.uint64(8))
            out[todo[rows >= 0]] += bits[rows[rows >= 0]]
        out[todo] += np.float32(RAW_BITS)
        return out


def build_model(counts, order: int) -> Model:
    """From rows (lang, k, gram, n): how often ``gram`` of k + 1 bytes came."""
    languages = sorted(set(counts["lang"]))
    column = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    level = counts["k"].to_numpy(np.int64)
    gram, n = counts["gram"].to_numpy(np.int64).view(np.uint64), counts["n"].to_numpy(np.float64)
    symbols, escapes = [], []
    for k in range(order + 1):
        mine = level == k
        keys, row = np.unique(gram[mine], return_inverse=True)
        contexts, above = np.unique(keys >> np.uint64(8), return_inverse=True)
        seen = np.zeros((len(keys), len(languages)))
        np.add.at(seen, (row, column[mine]), n[mine])
        total, kinds = np.zeros((2, len(contexts), len(languages)))
        np.add.at(total, above, seen)
        np.add.at(kinds, above, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0)
            own = np.log2((total + kinds)[above] / seen)
        if k:
            table, bits = symbols[k - 1]
            mask = np.uint64((1 << (8 * k)) - 1)
            rows = table.find(keys & mask)
            shorter = bits[rows]
        else:
            shorter = np.full((len(keys), len(languages)), RAW_BITS)
        bits = np.where(seen > 0, own, escape[above] + shorter)
        symbols.append((Table.of(keys), bits.astype(np.float32)))
        escapes.append((Table.of(contexts), escape.astype(np.float32)))
    return Model(languages, order, symbols, escapes)


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, k, gram, n) over the whole of each text of ``sample`` (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_pylist()
            for low, high, data, offsets in text_slices(batch.column(1), 4 * SLICE_BYTES):
                padded, at, ranges = folded(data, offsets, order)
                names, codes = np.unique(np.array(lang[low:high], object).astype(str), return_inverse=True)
                owner = np.repeat(codes, np.diff(ranges))
                for k in range(order + 1):
                    found = grams(padded, at, k + 1)
                    for code, name in enumerate(names):
                        keys, n = np.unique(found[owner == code], return_counts=True)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([str(name)] * len(keys), pa.string()),
                            pa.array(np.full(len(keys), k, np.int32)),
                            pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)),
                        ], names=["lang", "k", "gram", "n"])

    return sample.select("lang", "text").mapInArrow(run, "lang string, k int, gram bigint, n bigint") \
        .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on (doc_id, text, lang). Rows without text or lang teach nothing.

    The sample: per language the rows whose hash lies below ``sample_docs`` / its number of rows, so
    about ``sample_docs`` rows, each with its whole text.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], order, [], [])
    share = F.pmod(F.xxhash64("doc_id", F.lit("ppm")), F.lit(1 << 30)) / float(1 << 30)
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_docs / n))) for k, n in sizes.items()])
    return build_model(gram_counts(rows.filter(share < limit), order).toPandas(), order)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, and any columns named otherwise than below).

    Adds lang_pred, score (share of the winner when the code lengths of the whole text are read as
    equally likely hypotheses) and bits_per_byte of the winner. A null text, and one without a
    letter, is ``und`` with score 0; so is every text if the model has no language. Ties go to the
    first language in alphabetical order. Map only; a text is scored in numpy in one piece.
    """
    spark = docs.sparkSession
    shared = ship(spark, model)
    extra = "lang_pred string, score double, bits_per_byte double"
    inputs = docs.withColumn("__lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    place = inputs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(shared)
        for batch in batches:
            lettered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            pred, score, rate = [], [], []
            for low, high, data, offsets in text_slices(batch.column(place), SLICE_BYTES):
                padded, at, ranges = folded(data, offsets, model.order)
                if model.languages and len(at):
                    total = np.zeros((len(at) + 1, len(model.languages)))
                    np.cumsum(model.lengths(padded, at), axis=0, dtype=np.float64, out=total[1:])
                    bits = total[ranges[1:]] - total[ranges[:-1]]
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(len(bits)), best]
                    sure = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                    per_byte = least / np.maximum(np.diff(ranges), 1)
                    known = lettered[low:high]
                    pred += [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
                    score += np.where(known, np.clip(sure, 0, 1), 0.0).tolist()
                    rate += np.where(known, per_byte, RAW_BITS).tolist()
                else:
                    pred += [UNDETERMINED] * (high - low)
                    score += [0.0] * (high - low)
                    rate += [RAW_BITS] * (high - low)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return inputs.mapInArrow(run, f"{schema}, {extra}")


def accepted(identified: DataFrame) -> DataFrame:
    """Drop what has no language: ``und``, and texts no language codes shorter than raw bytes."""
    return identified.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") < RAW_BITS))
