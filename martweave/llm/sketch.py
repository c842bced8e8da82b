"""Count-min sketch over a whole table, built per partition and merged by slice.

Each task counts the cells of its own keys and sends them as short cell lists, so what is
shuffled follows the keys, not the width of the sketch.  Slices of `SLICE` cells are merged
independently.  Only one question is asked of the sketch, whether a key can occur in so
many documents (one or two), so counters saturate at two and the merged sketch is one bit a
cell: its size, `DEPTH * 2**bits / 8` bytes, is known before it is built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .scan import mix

DEPTH = 2
SLICE_BITS = 16
MIN_BITS, MAX_BITS = 18, 29
_FLUSH = 1 << 21
_SALTS = (0x2545F4914F6CDD1D, 0x8EBC6AF09C88C6E3)

_SCHEMA = pa.schema([("row", pa.int32()), ("slice", pa.int32()), ("cells", pa.binary())])


def bits_for(keys: int, most: int = MAX_BITS) -> int:
    """Width (as a power of two) with at least eight cells per key, within the bounds.

    `2**MAX_BITS` cells are 128 MB over both rows, enough for 67 million keys at that width.
    Beyond that the sketch fills up: it overestimates more keys, which the exact pass then has
    to sort out, and still loses none.  A cluster of larger executors can afford a higher `most`.
    """
    return min(most, max(MIN_BITS, int(max(keys, 1) * 8 - 1).bit_length()))


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(keys ^ np.uint64(_SALTS[row])) >> np.uint64(64 - bits)


def _partial(keys: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """The sketch of one task: per slice its cells, a cell at most twice."""
    for row in range(DEPTH):
        own = np.sort(cells(keys, row, bits))
        third = np.zeros(len(own), bool)
        third[2:] = own[2:] == own[:-2]
        own = own[~third]
        slices = (own >> np.uint64(SLICE_BITS)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(slices)) + 1
        parts = [p.astype("<u2").tobytes() for p in np.split(own & np.uint64((1 << SLICE_BITS) - 1), cuts)]
        names = slices[np.concatenate(([0], cuts))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(names), row, np.int32)), pa.array(names), pa.array(parts, pa.binary())], schema=_SCHEMA
        )


def _merge(least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, key = np.zeros(1 << SLICE_BITS, np.uint8), None
        for batch in batches:
            for row, part, raw in zip(*(c.to_pylist() for c in batch.columns)):
                key = row, part
                here = np.frombuffer(raw, "<u2")
                # a cell is listed at most twice here
                again = here[1:][here[1:] == here[:-1]]
                counts[here] = np.minimum(counts[here] + 1, 2)
                counts[again] = 2
        if key is not None:
            plane = np.packbits(counts >= least).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([plane], pa.binary())],
                schema=_SCHEMA,
            )

    return task


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, least: int = 2) -> np.ndarray:
    """The merged sketch: a bit plane per row, set where the count reaches `least` (1 or 2).

    `keys_of` yields the keys of a batch, each key once per document.
    """

    def task(batches):
        held, size = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size >= _FLUSH:
                    yield from _partial(np.concatenate(held), bits)
                    held, size = [], 0
        if size:
            yield from _partial(np.concatenate(held), bits)

    schema = "row int, slice int, cells binary"
    partial = df.mapInArrow(task, schema)
    planes = partial.groupBy("row", "slice").applyInArrow(_merge(least), schema)
    merged = np.zeros((DEPTH, 1 << (bits - 3)), np.uint8)
    step = 1 << (SLICE_BITS - 3)
    # bounded by DEPTH * 2**bits / 8 bytes, see above
    for row, part, raw in planes.collect():
        merged[row, part * step : (part + 1) * step] = np.frombuffer(raw, np.uint8)
    return merged


def reached(planes: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key's estimated count reaches what the planes were built for."""
    result = np.ones(len(keys), bool)
    for row in range(DEPTH):
        at = cells(keys, row, bits)
        result &= (planes[row][at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return result
