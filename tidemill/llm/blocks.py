"""Texts of an Arrow batch as byte arrays: words, lines and their hashes without a loop per word.

All functions work on a *block*: the UTF-8 bytes of some consecutive texts and the offsets that cut
them. Blocks are at most ``BLOCK_BYTES`` long unless a single text is longer, so the memory of a task
follows its longest text, not its number of rows.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemill.llm.common import without

BLOCK_BYTES = 1_000_000
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_libc = ctypes.CDLL("libc.so.6") if sys.platform == "linux" and ctypes.util.find_library("c") == "libc.so.6" else None

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[np.frombuffer(SPACES, np.uint8)] = False
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, offsets)``; nulls count as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    give_back()


def give_back() -> None:
    """Return freed memory to the system. Workers are kept for later tasks, and allocators keep what
    was freed, so that idle workers would hold the memory of their largest batch."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def runs(wanted: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the longest runs of true bytes; no run crosses a border."""
    n = len(wanted)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = wanted[:-1]
    starts = np.flatnonzero(wanted & (~before | border[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = wanted[1:]
    ends = np.flatnonzero(wanted & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space, tab, line feed, vertical tab, form feed, carriage return."""
    return runs(NOT_SPACE[data], offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces between line feeds, empty ones too."""
    feeds = np.flatnonzero(data == 10)
    text = np.searchsorted(offsets, feeds, "right") - 1
    starts = np.concatenate([offsets[:-1], feeds + 1])
    ends = np.concatenate([feeds, offsets[1:]])
    owner = np.concatenate([np.arange(len(offsets) - 1), text])
    order = np.lexsort((starts, owner))
    last = np.lexsort((ends, np.concatenate([text, np.arange(len(offsets) - 1)])))
    return starts[order], ends[last], owner[order]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_BASE), -1, 2**64)))
    down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from running sums over the block; equal spans get equal hashes."""
    size = (len(data) // BLOCK_BYTES + 1) * BLOCK_BYTES  # the same for all blocks of usual length
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First positions and hashes of all windows of ``width`` neighbours within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for k in range(width):
        total += hashes[k : k + n] * np.uint64(factor)
        factor = factor * int(_BASE) % 2**64
    first = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return first, mix(total[first])


def repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: does its text hold an equal item elsewhere, and does it hold an equal earlier one."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    same = (o[1:] == o[:-1]) & (h[1:] == h[:-1])
    again = np.zeros(len(owner), bool)
    again[1:] = same
    twice = again.copy()
    twice[:-1] |= same
    out_twice, out_again = np.empty_like(twice), np.empty_like(again)
    out_twice[order], out_again[order] = twice, again
    return out_twice, out_again


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over spans."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def with_text_columns(
    docs: DataFrame,
    text_col: str,
    added: StructType,
    compute: Callable[[pa.Array, np.ndarray, np.ndarray], list[pa.Array]],
) -> DataFrame:
    """``docs`` and the columns of ``added``, which ``compute`` makes of each block of whole texts.

    Input columns called like an added one are replaced, whatever the case of their names.
    """
    docs = without(docs, added.names)
    text_type = docs.schema[text_col].dataType
    docs = docs if isinstance(text_type, StringType) else docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = StructType([*docs.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(text_col)):
                rows = batch.slice(a, b - a)
                new = compute(rows.column(text_col), data, offsets)
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)
