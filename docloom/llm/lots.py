"""Words and their ids as Arrow and numpy columns: a worker keeps many and looks up a batch at once."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def joined_words(words: pa.Array, separator: str) -> str:
    rows = pa.LargeListArray.from_arrays([0, len(words)], words)
    return pc.binary_join(rows, pa.scalar(separator, pa.large_string()))[0].as_py()


def distinct(data: np.ndarray, first: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word of a UTF-8 text among its distinct ones, and these. ``first`` marks the
    bytes that begin a word, ``inside`` those in one.
    """
    kept = data[inside]
    starts = np.append(np.flatnonzero(first[inside]), len(kept))
    found = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(kept)]) \
        .dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def runs(ids: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` between ``bounds`` that ``which`` numbers, one after the other, and their bounds."""
    size = np.diff(bounds)[which]
    stops = np.append(0, np.cumsum(size))
    return ids[np.repeat(bounds[which] - stops[:-1], size) + np.arange(stops[-1])], stops


class Lot(NamedTuple):
    """Distinct words with their ids, those of each one between two bounds."""
    words: pa.Array
    ids: np.ndarray
    bounds: np.ndarray

    @classmethod
    def empty(cls) -> Lot:
        return cls(pa.array([], pa.large_string()), np.empty(0, "<u4"), np.zeros(1, np.int64))

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of ``words`` is in this lot, or -1."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def taken(self, places: np.ndarray) -> Lot:
        return Lot(self.words.take(pa.array(places)), *runs(self.ids, self.bounds, places))

    def __add__(self, other: Lot) -> Lot:
        return Lot(pa.concat_arrays([self.words, other.words]), np.concatenate([self.ids, other.ids]),
                   np.concatenate([self.bounds, self.bounds[-1] + other.bounds[1:]]))

    def as_dict(self) -> dict[str, bytes]:
        return {w: self.ids[a:b].tobytes() for w, a, b in zip(self.words.to_pylist(), self.bounds, self.bounds[1:])}


class Kept:
    """The lot in use and the one before it; a word met again moves over."""

    def __init__(self, limit: int, learn: Callable[[pa.Array], Lot]):
        self.limit, self.learn = limit, learn
        self.lot, self.older = Lot.empty(), Lot.empty()

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of ``words``, all distinct, is in ``lot``; unseen ones are learned."""
        if len(self.lot.words) > self.limit:
            self.lot, self.older = Lot.empty(), self.lot
        out = self.lot.places(words)
        if len(need := np.flatnonzero(out < 0)):
            before = self.older.places(words.take(pa.array(need)))
            again, fresh = need[before >= 0], need[before < 0]
            out[np.concatenate([again, fresh])] = len(self.lot.words) + np.arange(len(need))
            self.lot += self.older.taken(before[before >= 0])
            if len(fresh):
                self.lot += self.learn(words.take(pa.array(fresh)))
        return out

    def spelled(self, codes: np.ndarray, words: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs between ``bounds`` of ``codes``, numbers of ``words``, and the bounds of these."""
        places = self.places(words)
        ids, stops = runs(self.lot.ids, self.lot.bounds, places[codes])
        return ids, stops[bounds]
