"""CRC-32 of many byte strings at once, and of joined strings from the states of their parts."""

from __future__ import annotations

import zlib

import numpy as np

LONG = 48  # bytes from which on a string is left to zlib
_FLIP = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


BYTE = _byte_table()


def crc_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each ``data[start:end]``."""
    out = np.full(len(starts), _FLIP, np.uint32)
    length = ends - starts
    order = np.argsort(length, kind="stable")
    ranked = length[order]
    for k in range(int(min(ranked[-1], LONG)) if len(ranked) else 0):
        live = order[np.searchsorted(ranked, k, side="right"):np.searchsorted(ranked, LONG, side="right")]
        state = out[live]
        out[live] = BYTE[(state ^ data[starts[live] + k]) & np.uint32(255)] ^ (state >> np.uint32(8))
    out ^= _FLIP
    for i in order[np.searchsorted(ranked, LONG, side="right"):].tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return out


def _apply(images: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by the images of the bits, on every state."""
    out = np.zeros(len(states), np.uint32)
    for bit in range(32):
        out ^= np.where(states >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
    return out


def _after_zeros(count: int) -> np.ndarray:
    """Images of the bits under ``count`` zero bytes, by repeated squaring."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    power = BYTE[bits & np.uint32(255)] ^ (bits >> np.uint32(8))
    out = bits
    while count:
        if count & 1:
            out = _apply(power, out)
        power = _apply(power, power)
        count >>= 1
    return out


class Joiner:
    """crc32 of ``a + b`` from crc32 of ``a``, crc32 of ``b`` and the length of ``b``.

    CRC-32 is linear: ``b`` moves the state of ``a`` by as many zero bytes as it is long. The maps of
    lengths seen before are kept as tables, one for each byte of a state.
    """

    def __init__(self) -> None:
        self.tables: dict[int, np.ndarray] = {}

    def _table(self, length: int) -> np.ndarray:
        if length not in self.tables:
            if len(self.tables) >= 256:
                self.tables.clear()
            images = _after_zeros(length)
            low = np.arange(256, dtype=np.uint32)
            self.tables[length] = np.stack([_apply(images, low << np.uint32(8 * i)) for i in range(4)])
        return self.tables[length]

    def __call__(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = b.astype(np.uint32)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                table, state = self._table(int(length[part[0]])), a[part]
                moved = table[0][state & np.uint32(255)]
                for i in (1, 2, 3):
                    moved ^= table[i][state >> np.uint32(8 * i) & np.uint32(255)]
                out[part] ^= moved
        return out
