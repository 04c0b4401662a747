"""Words and their hashes for a batch of texts at once, as numpy arrays over the raw UTF-8 bytes.

Used inside Arrow map functions: Spark cuts the rows into tasks, each task works through its batches
in slices of about ``SLICE`` bytes (a longer single text is one slice), so memory is bounded by the
slice or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants that depend on ``seed`` only."""
    return mix(np.arange(1, n + 1, dtype=U64) * _GOLDEN + U64(seed)) | U64(1)


_BYTE_VALUES = constants(256, 101)
_BASE = int(constants(1, 202)[0])
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"n": 0, "up": np.empty(0, U64), "down": np.empty(0, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        n = max(n, SLICE)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            factors = np.full(n + 1, U64(base))
            factors[0] = U64(1)
            _POWERS[name] = np.cumprod(factors)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def byte_set(test) -> np.ndarray:
    """A table of 256 booleans: the bytes for which ``test`` holds."""
    return np.array([bool(test(b)) for b in range(256)])


# Bytes of words [^\x20\x09-\x0D]+: all but blanks.
NOT_BLANK = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text: digits, a-z and every non-ASCII letter.
ALNUM = byte_set(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each text (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers, n = column.buffers(), len(column)
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each; a longer text is a range of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


class Words:
    """The words of consecutive texts: where each begins and ends in ``data`` and its 64-bit hash.

    ``first[i]:first[i + 1]`` are the words of text ``i``. Words never cross texts.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        inside = word_bytes[self.data]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edge] = False
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edge[edge > 0] - 1] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, from running sums: no loop over spans."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """For each position the hash of the ``n`` words from there on; shorter by ``n - 1`` than ``words``."""
    if len(words) < n:
        return np.empty(0, U64)
    factors = constants(n, 303 + n)
    total = words[:len(words) - n + 1] * factors[0]
    for k in range(1, n):
        total = total + words[k:len(words) - n + 1 + k] * factors[k]
    return mix(total)


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``begin, begin + 1, ...`` of each stretch, one stretch after the other."""
    after = np.cumsum(sizes)
    total = int(after[-1]) if len(after) else 0
    return np.repeat(begins - (after - sizes), sizes) + np.arange(total)
