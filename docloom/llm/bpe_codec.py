"""BPE encoding and decoding with content-defined chunks that are encoded once and reused.

A rolling hash over the last ``WINDOW`` bytes cuts each text into chunks, so texts that share a
passage share its inner chunks whatever stands around them. Rows are dealt by the least chunk hash
of their text, which copies and near copies share; a worker keeps the encodings of its chunks over
its tasks, within a bound, and encodes an unseen chunk once. The deal is a rebalance: a key with many
rows is split over tasks by size, at the price of encoding its chunks once in each worker.

A chunk encoded alone may differ from the whole text around its ends. Each join is repaired: from
the last certain split of the left chunk to some way into the right one the text is encoded again,
further and further, until it begins a piece where the right chunk does and is certain of it. From
there on both agree (see ``tokens.guard``).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import tokens
from docloom.llm.lots import Kept, Lot, distinct, joined_words
from docloom.llm.words import mix, text_slices

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 32
MASK = np.uint64((1 << 11) - 1)  # a cut every 2,048 bytes on average
LEAST, MOST = 512, 8192  # bytes of a chunk, but for the last of a text
REACH = 48  # characters a repair first takes from the right chunk
KEPT_UNITS = 400_000  # units whose ids a worker keeps, and as many again that it kept before
GROUP = 256  # units encoded as one text
UNEVEN = re.compile(r"\s\s|[^\S \n]")  # white space that is not single, or another kind
CLOSED = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[.,]")
EDGE_UNITS = 48  # units at each end of a chunk whose places are kept
BREAK = "\0"  # stands between texts of units, and in none
KEPT_BYTES = 32 << 20  # text whose encodings a worker keeps
SLICE_BYTES = 2 << 20  # text whose distinct units are looked up together
TABLE = 1 << 16  # powers a worker keeps for the rolling hash

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end with each byte; shorter at the front."""
    size = len(data) + 1
    if size > TABLE:
        power, back = powers(_BASE, size), powers(_UNDO, size)
    else:
        power, back = (x[:size] for x in tokens.per_worker(
            ("powers", TABLE), lambda: (powers(_BASE, TABLE), powers(_UNDO, TABLE))))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    first = np.maximum(np.arange(1, len(data) + 1) - WINDOW, 0)
    return mix((total[1:] - total[first]) * back[first])


def cuts(data: np.ndarray) -> list[int]:
    """End of every chunk of one text, at characters' ends."""
    ends, start, size = [], 0, len(data)
    marks = np.flatnonzero((rolling(data) & MASK) == 0) + 1
    while size - start > LEAST:
        k = np.searchsorted(marks, start + LEAST)
        end = min(int(marks[k]) if k < len(marks) else size, start + MOST, size)
        while end < size and data[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        start = end
    if start < size or not ends:
        ends.append(size)
    return ends


def chunks(text: bytes) -> list[bytes]:
    ends = cuts(np.frombuffer(text, np.uint8))
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def token_bytes(tokenizer) -> list[bytes] | None:
    """Bytes of each token of a byte-level vocabulary by id; None for another kind of decoder.

    A token with a character that stands for no byte stands for itself, as in the library.
    """
    if (json.loads(tokenizer.to_str())["decoder"] or {}).get("type") != "ByteLevel":
        return None
    alphabet = {c: b for b, c in enumerate(tokens.byte_letters())}
    ids = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(ids.values(), default=-1) + 1)
    for token, i in ids.items():
        out[i] = bytes(map(alphabet.__getitem__, token)) if alphabet.keys() >= set(token) else token.encode()
    return out


class Decoder:
    """Decodes ids: by the bytes of their tokens, or else by the library."""

    def __init__(self, tokenizer):
        self.tokenizer, self.table = tokenizer, token_bytes(tokenizer)

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        if self.table is None:
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [b"".join(map(self.table.__getitem__, own)).decode("utf-8", "replace") for own in ids]


class Encoded(NamedTuple):
    text: str
    ids: np.ndarray
    points: np.ndarray  # characters where pieces begin; of a long text of units, those near its ends
    at: np.ndarray  # their tokens


class Coder:
    """Encodes texts through kept chunks.

    Where all white space of a chunk is single spaces and line feeds, each between two other
    characters or at an end, the byte-level pattern begins a piece at every space and around every
    line feed. Such a chunk is encoded unit by unit (a word with the space before it, a line feed)
    through kept units, each distinct one of a batch looked up once; any other chunk goes to the
    library whole, and so does the short text of a repair.
    """

    def __init__(self, tokenizer, kept_bytes: int = KEPT_BYTES, kept_units: int = KEPT_UNITS):
        self.tokenizer, self.margin, self.kept_bytes = tokenizer, tokens.guard(tokenizer), kept_bytes
        self.kept: dict[bytes, Encoded] = {}
        self.size = self.made = 0
        self.units, self.parts = Kept(kept_units, self.learn), Kept(kept_units, self.learn_parts)
        splitter = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
        self.by_units = tokenizer.normalizer is None and splitter.get("type") == "ByteLevel" \
            and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.feed = self.library("\n")

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, units: pa.Array) -> Lot:
        """Ids of unseen units. Plain letters with a stop or comma behind them are two pieces, and only
        those of the two that are unseen are encoded."""
        own = joined_words(units, BREAK).split(BREAK)
        closed = [CLOSED.fullmatch(u) is not None for u in own]
        text = BREAK.join([u[:-1] + BREAK + u[-1] if two else u for u, two in zip(own, closed)])
        data = np.frombuffer(text.encode(), np.uint8)
        inside = data != ord(BREAK)
        first = inside & np.append(True, ~inside[:-1])
        return Lot(units, *self.parts.spelled(*distinct(data, first, inside), np.append(0, np.cumsum(1 + np.array(closed)))))

    def learn_parts(self, parts: pa.Array) -> Lot:
        """Encode parts many at a time; a line feed between them is always a token alone."""
        need, ids, sizes = joined_words(parts, BREAK).split(BREAK), [], []
        for k in range(0, len(need), GROUP):
            group = need[k:k + GROUP]
            found = np.array(self.tokenizer.encode_batch_fast(["\n".join(group)], add_special_tokens=False)[0].ids, "<u4")
            feed = found == self.feed[0]
            if feed.sum() == len(group) - 1 and " " not in group:
                ids.append(found[~feed])
                sizes.append(np.diff(np.flatnonzero(np.concatenate([[True], feed, [True]]))) - 1)
            else:
                alone = list(map(self.library, group))
                ids += alone
                sizes.append(np.array(list(map(len, alone))))
        return Lot(parts, np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(sizes))))

    def by_library(self, texts: list[str]) -> list[Encoded]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [Encoded(t, np.array(e.ids, np.uint32), *tokens.split_points(e)) for t, e in zip(texts, found)]

    def of_units(self, texts: list[str]) -> Iterator[Encoded]:
        data = np.frombuffer(BREAK.join(texts).encode(), np.uint8)
        inside, feed = data != ord(BREAK), data == ord("\n")
        first = inside & (feed | (data == ord(" ")))
        first |= inside & np.append(True, (feed | ~inside)[:-1])[:len(data)]
        starts, breaks = np.flatnonzero(first), np.flatnonzero(~inside)
        codes, words = distinct(data, first, inside)
        ids, at = self.units.spelled(codes, words, np.arange(len(codes) + 1))
        places = np.cumsum(data & 0xC0 != 0x80)[starts] - 1
        bounds = [0, *np.searchsorted(starts, breaks).tolist(), len(starts)]
        begin = 0  # of the text, in characters
        for text, a, b in zip(texts, bounds, bounds[1:]):
            # Joins only ask for the pieces near the ends.
            near = slice(a, b) if b - a <= 2 * EDGE_UNITS else np.r_[a:a + EDGE_UNITS, b - EDGE_UNITS:b]
            yield Encoded(text, ids[at[a]:at[b]].copy(), places[near] - begin, at[near] - at[a])
            begin += len(text) + 1

    def encoded(self, texts: list[str]) -> list[Encoded]:
        plain = [self.by_units and not UNEVEN.search(t) and BREAK not in t and not any(s in t for s in self.special)
                 for t in texts]
        known = self.of_units([t for t, ok in zip(texts, plain) if ok])
        whole = iter(self.by_library([t for t, ok in zip(texts, plain) if not ok]))
        return [next(known if ok else whole) for ok in plain]

    def encode_batch(self, texts: list[bytes]) -> list[np.ndarray]:
        parts = [chunks(t) for t in texts]
        need = {c: None for own in parts for c in own if c not in self.kept}
        self.size += sum(map(len, need))
        if self.size > self.kept_bytes:
            self.kept.clear()
            need = {c: None for own in parts for c in own}
            self.size = sum(map(len, need))
        self.made += len(need)
        self.kept.update(zip(need, self.encoded([c.decode() for c in need])))
        return [self.joined([self.kept[c] for c in own]) for own in parts]

    def joined(self, parts: list[Encoded]) -> np.ndarray:
        left, first, out = parts[0], 0, []  # ``first``: token of ``left`` at its last splice
        rest = iter(parts[1:])
        for right in rest:
            sure = np.flatnonzero((left.points <= len(left.text) - self.margin) & (left.at >= first))
            if len(sure):
                point, token = int(left.points[sure[-1]]), int(left.at[sure[-1]])
            elif first < len(left.ids):
                point, token = int(left.points[np.searchsorted(left.at, first)]), first
            else:
                point, token = len(left.text), first
            out.append(left.ids[first:token])
            head, reach = left.text[point:], REACH
            # A stretch without splits grows by its own length, so it is encoded a few times only.
            grown = 2 * len(head)
            while len(head) + len(right.text) < grown and len(head) > len(right.text) and (after := next(rest, None)):
                head, right = head + right.text, after
            while True:
                reach = min(reach, len(right.text))
                again = self.by_library([text := head + right.text[:reach]])[0]
                ours = again.points[again.points <= len(text) - self.margin] - len(head)
                common = np.intersect1d(ours, right.points)
                if len(common):
                    splice = int(common[0])
                    out.append(again.ids[:again.at[np.searchsorted(again.points, splice + len(head))]])
                    left, first = right, int(right.at[np.searchsorted(right.points, splice)])
                    break
                if reach == len(right.text):  # never agreed: the repair stands for the right chunk
                    left, first = again, 0
                    break
                reach *= 2
        out.append(left.ids[first:])
        return np.concatenate(out)


def routed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``route``, the least chunk hash of the text; null reads as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("") if batch.column(1).null_count else batch.column(1)
            keys = []
            for low, high, data, offsets in text_slices(texts):
                raw = data.tobytes()
                for a, b in zip(offsets[:-1], offsets[1:]):
                    keys.append(min(int.from_bytes(hashlib.blake2b(c, digest_size=7).digest(), "little")
                                    for c in chunks(raw[a:b])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), texts.cast(pa.string()), pa.array(keys, pa.int64())], names=["doc_id", "text", "route"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string, route bigint") \
        .hint("rebalance", F.col("route"))


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text), and with
    ``keep_ids`` also ids (array<int>) and decoded.

    A null text reads as empty and has no ids. Repeated rows give repeated results, an empty table none.
    Special strings inside a text become their ids, as the library does by default. A very long text is
    encoded by chunks; a stretch without splits, however long, in time linear in its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.load(vocabulary)
        coder = tokens.per_worker(("chunks", vocabulary), lambda: Coder(tokenizer))
        decoder = tokens.per_worker(("decoder", vocabulary), lambda: Decoder(tokenizer))
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                raw = data.tobytes()
                ids = coder.encode_batch([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
                decoded = decoder.decode_batch([x.tolist() for x in ids])
                columns = [
                    batch.column(0)[low:high], pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    extra = ", ids array<int>, decoded string" if keep_ids else ""
    return routed(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + extra)
