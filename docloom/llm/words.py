"""Vector helpers on Arrow text: slices of a batch, word bounds, hashes. All run inside tasks."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# The white space that ends a word, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# What stands between words of digits, letters and all beyond ASCII (0x00-0x2F,
# 0x3A-0x60, 0x7B-0x7F), in lower-cased text.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0x00:0x30] = PUNCTUATION[0x3A:0x61] = PUNCTUATION[0x7B:0x80] = True


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows of about ``limit`` bytes.

    A null reads as an empty text; a text above the limit is a slice of its own, never cut.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, values[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective finisher on unsigned 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of every word, and the range of words of each text (length texts + 1)."""
    inside = ~gap[data]
    left = np.zeros(len(data) + 1, bool)
    left[1:] = inside
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (~left[:-1] | first[:-1]))
    after = np.append(inside[1:], False)
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, equal for equal bytes wherever they stand."""
    power = np.full(len(data) + 1, _ODD, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    back = np.full(len(data) + 1, _INVERSE, np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return mix((total[ends] - total[starts]) * back[starts])


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i:i + count]
    return mix(out)


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def ship(spark: SparkSession, value):
    """Broadcast ``value`` with its classes, which workers need not have installed."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(broadcast):
    return pickle.loads(broadcast.value)
