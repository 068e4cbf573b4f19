"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

A piece is known to the packing by its length alone, so the instance is a histogram of at most
``capacity`` rows whatever the corpus holds. The plan (which lengths share a sequence, and how many
sequences look like that) is made from the histogram; pieces then take the plan's places by their
rank within their length, in a map over all pieces. Only the histogram and the plan, both bounded by
``capacity``, pass through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import tokens
from docloom.llm.lots import Kept, Lot, distinct, joined_words
from docloom.llm.words import SPACE, ship, shipped, text_slices
from docloom.session import scratch

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END = 0  # id that ends a document
RANK_ROWS = 50_000  # pieces ranked together in one task
KEPT_WORDS = 100_000  # words whose ids a worker keeps, and as many again that it kept before
KEPT_PARTS = 150_000  # likewise, parts of words
SLICE_BYTES = 2 << 20  # text whose distinct words are looked up together

# Text of these characters is split by white space first: lower-casing, composing and the pattern of
# the vocabulary then act on each word alone, and lower-casing keeps them single and of two bytes at
# most. Any other text goes to the library whole.
GROUP = 256  # parts encoded as one text
PLAIN = regex.compile(r"[\x00-\x1b\x20-\x7f\xa1-ɏ--İȺȾ]*", regex.V1)
BREAK = "\x1c"  # stands between plain texts, and in none
GAP = SPACE.copy()
GAP[ord(BREAK)] = True
# Fixed values of the vocabulary's pattern, by code point: a part is a run of letters, one digit, or
# a run of other characters.
LETTER, DIGIT, OTHER = 1, 2, 3
KIND = np.array([0 if c < 256 and GAP[c] else LETTER if regex.match(r"\p{L}", chr(c)) else
                 DIGIT if regex.match(r"\p{N}", chr(c)) else OTHER for c in range(0x800)], np.uint8)


def all_plain(text: str) -> bool:
    """Whether ``PLAIN`` matches ``text``."""
    data = np.frombuffer(text.encode(), np.uint8)
    if (data - np.uint8(0x1C) < 4).any() or (data >= 0xCA).any():
        return False
    lead = np.flatnonzero(data >= 0xC2)
    kind, rest = data[lead], data[lead + 1]
    return not ((kind == 0xC2) & (rest <= 0xA0) | (kind == 0xC9) & (rest > 0x8F) | (kind == 0xC4) & (rest == 0xB0)
                | (kind == 0xC8) & ((rest == 0xBA) | (rest == 0xBE))).any()


def part_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of lower-cased plain text begin a part, as the vocabulary's pattern
    ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+`` finds them, and which are in one.
    """
    kind = KIND[data]
    whole = np.ones(len(data), bool)  # first byte of a character
    lead = np.flatnonzero(data >= 0xC2)
    kind[lead] = kind[lead + 1] = KIND[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
    whole[lead + 1] = False
    inside = kind > 0
    first = inside & whole
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # A quote that begins a part takes the letters of a contraction; what is left of these is a part.
    after = np.append(kind, np.zeros(3, np.uint8)), np.append(data, np.zeros(3, np.uint8))
    quote = np.flatnonzero(first & (data == ord("'")))
    quote = quote[after[0][quote + 1] == LETTER]
    one, two = after[1][quote + 1], after[1][quote + 2]
    short = np.isin(one, list(b"stmd"))
    long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    first[quote[short | long] + 1] = False
    left = np.concatenate([quote[short] + 2, quote[long] + 3])
    first[left[after[0][left] == LETTER]] = True
    return first, inside


class WordCoder:
    """Ids of texts, as bytes of little-endian 32-bit numbers, through kept words.

    A plain text is lower-cased (its letters are composed already) and split by white space. Each
    distinct word of a batch is looked up once. Unseen words are cut by the vocabulary's pattern into
    parts, and unseen parts are encoded many at a time: each ends in a token that carries the end of
    a word. Normalized and cut as they are, parts need the library's model alone.
    """

    def __init__(self, tokenizer, kept_words: int = KEPT_WORDS, kept_parts: int = KEPT_PARTS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.kept, self.parts = Kept(kept_words, self.learn), Kept(kept_parts, self.learn_parts)
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.bare = Tokenizer(tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.spelling = {b: c for b, c in enumerate(tokens.byte_letters()) if b != ord(" ")}

    @property
    def words(self) -> dict[str, bytes]:
        return self.kept.lot.as_dict()

    @property
    def older(self) -> dict[str, bytes]:
        return self.kept.older.as_dict()

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def bare_ids(self, parts: str) -> np.ndarray:
        """Ids of parts with a space between them, as the byte-level vocabulary spells them."""
        if not (parts.isascii() and parts.isprintable()):
            parts = parts.encode().decode("latin-1").translate(self.spelling)
        return np.array(self.bare.encode_batch_fast([parts], add_special_tokens=False)[0].ids, "<u4")

    def learn_parts(self, parts: pa.Array) -> Lot:
        ids, sizes = [], []
        for k in range(0, len(parts), GROUP):
            text = joined_words(parts[k:k + GROUP], " ")
            own = [self.bare_ids(text)]
            stops = np.flatnonzero(self.ends[own[0]]) + 1
            if len(stops) != text.count(" ") + 1:
                own = list(map(self.bare_ids, text.split(" ")))
                stops = np.cumsum(list(map(len, own)))
            ids += own
            sizes.append(np.diff(stops, prepend=0))
        return Lot(parts, np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(sizes))))

    def learn(self, words: pa.Array) -> Lot:
        data = np.frombuffer(joined_words(words, " ").encode(), np.uint8)
        first, inside = part_starts(data)
        ends = np.searchsorted(np.flatnonzero(first), np.append(np.flatnonzero(data == ord(" ")), len(data)))
        return Lot(words, *self.parts.spelled(*distinct(data, first, inside), np.append(0, ends)))

    def plain_texts(self, texts: list[str]) -> Iterator[bytes]:
        data = np.frombuffer(BREAK.join(texts).lower().encode(), np.uint8)
        inside = ~GAP[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        ends = np.searchsorted(np.flatnonzero(first), np.append(np.flatnonzero(data == ord(BREAK)), len(data)))
        ids, bounds = self.kept.spelled(*distinct(data, first, inside), np.append(0, ends))
        raw, at = ids.tobytes(), (4 * bounds).tolist()
        return map(raw.__getitem__, map(slice, at, at[1:]))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        joined = " ".join(texts)
        sure, special = all_plain(joined), any(s in joined for s in self.special)
        plain = [(sure or PLAIN.fullmatch(t) is not None) and not (special and any(s in t for s in self.special)) for t in texts]
        known = self.plain_texts([t for t, ok in zip(texts, plain) if ok])
        whole = iter(self.library([t for t, ok in zip(texts, plain) if not ok]))
        return [next(known) if ok else next(whole).tobytes() for ok in plain]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs`` (doc_id, text). Map only.

    A text's ids and the end id are cut every ``capacity`` ids. Null and empty texts are the end id
    alone. Repeated rows give repeated pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.per_worker(("words", vocabulary), lambda: WordCoder(tokens.load(vocabulary)))
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                raw = data.tobytes()
                ids = coder.encode_batch([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
                row, piece, length, crc = [], [], [], []
                for i, own in enumerate(ids):
                    own += end
                    for k in range(0, len(own), 4 * capacity):
                        part = own[k:k + 4 * capacity]
                        row.append(low + i)
                        piece.append(k // (4 * capacity))
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                number = np.array(piece, np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(number.astype(np.int32)),
                    pa.array(number * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class Pattern(NamedTuple):
    """``count`` sequences that each hold ``items``: (length, how many of it)."""
    items: tuple[tuple[int, int], ...]
    count: int


def reduce_dominated(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix the sets that dominate every other set with the same largest piece, out of ``left``
    (pieces by length), until none is found.

    For the largest piece w: if nothing fits beside it, {w} dominates. If a piece fills it exactly,
    that pair does. If the two smallest others do not fit together, w takes at most one more
    piece, and the largest that fits dominates. Otherwise w stays for best fit, and the next length
    is asked. Counts are fixed at once, so the work grows with the lengths and not with the pieces.
    """
    fixed = []
    for w in range(capacity, 0, -1):
        while left[w]:
            room = capacity - w
            others = left.copy()
            others[w] -= 1
            fits = np.flatnonzero(others[:room + 1])
            if not len(fits):
                fixed.append(Pattern(((w, 1),), int(left[w])))
                left[w] = 0
                break
            best, least = int(fits[-1]), int(fits[0])
            second = least if others[least] > 1 else int(fits[1]) if len(fits) > 1 else capacity + 1
            if best != room and least + second <= room:
                break
            if best == w:  # 2w <= capacity: pairs of one length
                times = int(left[w]) // 2
                fixed.append(Pattern(((w, 2),), times))
                left[w] -= 2 * times
                continue
            times = int(min(left[w], left[best]))
            if best != room:
                # Fixing ``best`` may not use up what keeps the two smallest from fitting.
                spare = int(left[least]) - (2 if second == least else 1)
                times = times if best != least else max(1, min(times, spare))
            fixed.append(Pattern(((w, 1), (best, 1)), times))
            left[w] -= times
            left[best] -= times
    return fixed


def best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, longest first, of whole groups of equal sequences at a time.

    A piece goes to the open sequence with the least room that holds it. That sequence stays the
    tightest until the length no longer fits, so equal sequences fill one after the other and a
    group of them takes its share in one step.
    """
    open_by_room: dict[int, list[list]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for w in range(capacity, 0, -1):
        n = int(left[w])
        while n:
            fit = np.flatnonzero(rooms[w:])
            if len(fit):
                room = w + int(fit[0])
                items, count = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms[room] = False
            else:
                room, items, count = capacity, (), -(-n // (capacity // w))
            each = room // w
            full = min(count, n // each)
            part = n % each if full < count and n // each == full else 0
            shares = [(full, each), (1 if part else 0, part)]
            shares.append((count - full - (1 if part else 0), 0))
            for many, k in shares:
                if many:
                    rest = room - k * w
                    open_by_room.setdefault(rest, []).append([(*items, (w, k)) if k else items, many])
                    rooms[rest] = True
            n -= full * each + part
    return [Pattern(items, count) for group in open_by_room.values() for items, count in group if items]


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    fixed = reduce_dominated(left, capacity)
    return fixed + best_fit(left, capacity)


class Places(NamedTuple):
    """By length: from which rank, in which sequence, how many per sequence, at which offset."""
    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    each: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]

    @classmethod
    def of(cls, plan: list[Pattern]) -> Places:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for items, count in plan:
            offset = 0
            for length, k in items:
                rank = taken.get(length, 0)
                rows.setdefault(length, []).append((rank, base, k, offset))
                taken[length] = rank + count * k
                offset += length * k
            base += count
        return cls(*({n: np.array([r[i] for r in own], np.int64) for n, own in rows.items()} for i in range(4)))

    def locate(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.first[length], rank, side="right") - 1
        inner, each = rank - self.first[length][row], self.each[length][row]
        return self.sequence[length][row] + inner // each, self.offset[length][row] + inner % each * length


def ranked(cut: DataFrame, rank_rows: int = RANK_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``cut`` with ``rank`` from 0 within each length, and the histogram.

    Ranks are numbered within (length, bucket) and shifted by the rows in earlier buckets, so that
    a length with most of all rows is no single task.
    """
    total = cut.count()
    buckets = max(1, -(-total // rank_rows))
    marked = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    sizes = marked.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    out = marked.withColumn("own", F.row_number().over(within) - 1) \
        .join(shift, ["length", "bucket"]).withColumn("rank", F.col("own") + F.col("shift"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    return out.drop("bucket", "own", "shift"), histogram


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
         rank_rows: int = RANK_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    Pieces are written once to the shared folder, as both the plan and the places need them; texts
    are encoded once. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch(spark, "pieces")
    pieces(docs, vocabulary, capacity).write.parquet(path)
    rows, histogram = ranked(spark.read.parquet(path), rank_rows)
    shared = ship(spark, Places.of(make_plan(histogram, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shipped(shared)
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros((2, len(length)), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
                sequence[part], offset[part] = places.locate(int(length[part[0]]), rank[part])
            kept = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                names=[*kept.schema.names, "sequence_id", "offset"])

    return rows.mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "sequence_id bigint, offset bigint")
