"""Words of whole Arrow batches in numpy, shared by the operators that read text."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from weftgraph.operators.runtime import settings

SLICE_BYTES = 1 << 18
"""Text handled at once in a task; a longer text is handled alone. Hashing words takes some 35 times that in memory."""
BATCH_BYTES = 4 << 20
"""Rows sent to a task's Python worker at once, where ``small_batches`` holds."""

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words that end at all ASCII but digits and letters.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def small_batches(spark: SparkSession):
    """Whole texts go to Python workers a few MB at a time, in jobs that run while the block does."""
    return settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES})


def release() -> None:
    """Give memory that is no longer used back to the system, which a worker that waits for its next task would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``size`` bytes of text, or one row."""
    if batch.num_rows == 0:
        return
    offsets = _offsets(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
    release()


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    found = np.frombuffer(column.buffers()[1], dtype=kind, count=column.offset + len(column) + 1)
    return found[column.offset :].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def spans(raw: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of ``letters``, none over the bound of two texts."""
    inside = letters[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    edges = bounds[bounds < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def counts_per_text(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie in each text."""
    return np.diff(np.searchsorted(starts, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, never zero, the same wherever the span stands."""
    n = len(raw)
    up, down = np.full(n, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
    up[:1], down[:1] = 1, 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]) | np.uint64(1)
