"""Whole-batch text scanning: words and rolling hashes of many texts as numpy arrays.

An Arrow string column is one byte buffer with offsets, so words, their hashes and the hashes
of all k-word spans come from a few array operations per block of about `BLOCK_BYTES`; no
Python code runs per word.  A text longer than a block is a block of its own and is never
cut.  Hashes are polynomials modulo 2**64 with a final mix: the difference of two prefix sums
times a power of the inverse base is the hash of the bytes (or words) between.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict = {}


class Words(NamedTuple):
    """Byte range of each word; `first[i]:first[i + 1]` are the words of text i."""

    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the splitmix64 finalizer)."""
    x = values ^ (values >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# words between blanks: every byte but 09-0D and 20
BLANK_SEPARATED = ~byte_table((0x09, 0x0D), (0x20, 0x20))
# words of digits, letters and everything beyond ASCII; capitals are folded, so they count too
ALPHANUMERIC = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_AS_IS = np.arange(256, dtype=np.uint8)
LOWER = _AS_IS.copy()
LOWER[0x41:0x5B] += 0x20


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64, len(filled) + 1, filled.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of whole texts."""
    data, off = column_bytes(texts)
    low, rows = 0, len(off) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(off, off[low] + limit, "right")) - 1)
        yield low, high, data[off[low] : off[high]], off[low : high + 1] - off[low]
        low = high


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> Words:
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(off), np.int64))
    inside = table[data]
    before = np.empty(size, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(size, bool)
    after[-1], after[:-1] = False, inside[1:]
    begins = off[:-1][off[:-1] < size]
    before[begins] = False
    after[begins[begins > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    stop = np.flatnonzero(inside & ~after) + 1
    return Words(start, stop, np.searchsorted(start, off))


def _power_table(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers.get(base)
    if known is None or len(known[0]) < size:
        length = max(size, BLOCK_BYTES + 1)

        def table(step: int) -> np.ndarray:
            factors = np.full(length, step, _U)
            factors[0] = 1
            return np.multiply.accumulate(factors)

        known = _powers[base] = table(base), table(pow(base, -1, 1 << 64))
    return known


class Prefix:
    """Prefix sums of a value sequence, from which the hash of any span is read off."""

    def __init__(self, values: np.ndarray, which: int = 0):
        power, self.inverse = _power_table(_BASES[which], len(values) + 1)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def span(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (self.sums[high] - self.sums[low]) * self.inverse[low]

    def every(self, length: int) -> np.ndarray:
        """Hashes of all spans of `length` values, by start."""
        count = len(self.sums) - length
        if count <= 0:
            return np.zeros(0, _U)
        return mix((self.sums[length:] - self.sums[:count]) * self.inverse[:count])


def byte_values(which: int, fold: bool) -> np.ndarray:
    table = mix((np.arange(256, dtype=_U) + _U(1)) * _U(_BASES[which]))
    return table[LOWER] if fold else table


def word_hashes(data: np.ndarray, found: Words, which: int = 0, fold: bool = False) -> np.ndarray:
    """A 64-bit hash per word; two words of equal bytes have equal hashes."""
    prefix = Prefix(byte_values(which, fold)[data], which)
    lengths = (found.stop - found.start).astype(_U)
    return mix(prefix.span(found.start, found.stop) + lengths * _U(0xD6E8FEB86659FD93))


def text_hash(text: str, which: int = 0, fold: bool = False) -> int:
    """The hash `word_hashes` gives for a word with these bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    one = np.array([0]), np.array([len(data)])
    return int(word_hashes(data, Words(*one, np.array([0, 1])), which, fold)[0])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by start."""
    if len(values) < width:
        return values[:0]
    span, result = 1, values
    while span * 2 <= width:
        result = np.minimum(result[:-span], result[span:])
        span *= 2
    rest = width - span
    return np.minimum(result[:-rest], result[rest:]) if rest else result


def owners(first: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def joined(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    """The given words joined by one space."""
    raw = data.tobytes()
    return b" ".join([raw[a:b] for a, b in zip(start.tolist(), stop.tolist())])
