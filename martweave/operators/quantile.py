"""Exact order statistics of a double column without sorting it.

Doubles whose bits are read as integers, with those of negative numbers inverted, are in order.
A pass counts the next 16 bits of the values that share the prefix found so far; four passes find
a value.  Each task sends at most 65,536 counts per prefix, whatever it reads, and no pass moves rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# task code travels with the job, so workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BITS, _PASSES = 16, 4
_SIGN = np.uint64(1 << 63)


def _counter(prefixes: Sequence[int], done: int):
    """Counts of the digit after `done` digits, per prefix, over the batches of a task."""
    shift = 64 - _BITS * (done + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(prefixes), 1 << _BITS), dtype=np.int64)
        for batch in batches:
            # minus zero equals zero
            values = batch.column(0).to_numpy(zero_copy_only=False) + 0.0
            bits = values.view(np.uint64)
            keys = np.where(bits & _SIGN, ~bits, bits | _SIGN) >> np.uint64(shift)
            digits = (keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            head = keys >> np.uint64(_BITS) if done else np.zeros(len(keys), dtype=np.uint64)
            for n, prefix in enumerate(prefixes):
                counts[n] += np.bincount(digits[head == np.uint64(prefix)], minlength=1 << _BITS)
        which, digit = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(digit, pa.int32()), pa.array(counts[which, digit], pa.int64())],
            names=["which", "digit", "n"],
        )

    return count


def _value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & ((1 << 64) - 1)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int]) -> list[float]:
    """The values at the 0-based `ranks` among the values of `column` in rising order.

    Nulls and NaN are left out, infinities take part.  `df` is read four times: store a costly
    one first.  A rank outside the values is an error.
    """
    values = _known(df, column)
    # per rank: the digits found so far, and the rank among the values that share them
    found = [(0, int(rank)) for rank in ranks]
    for done in range(_PASSES):
        prefixes = sorted({prefix for prefix, _ in found})
        counted = values.mapInArrow(_counter(prefixes, done), "which int, digit int, n long")
        # at most 65,536 rows per prefix
        rows = counted.groupBy("which", "digit").agg(F.sum("n").alias("n")).collect()
        tables = {prefix: sorted((r.digit, r.n) for r in rows if r.which == n) for n, prefix in enumerate(prefixes)}
        found = [_next_digit(tables[prefix], prefix, rank) for prefix, rank in found]
    return [_value(key) for key, _ in found]


def _next_digit(table: list[tuple[int, int]], prefix: int, rank: int) -> tuple[int, int]:
    if rank >= 0:
        for digit, n in table:
            if rank < n:
                return (prefix << _BITS) | digit, rank
            rank -= n
    raise ValueError("rank outside the values")


def _known(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The value below which `share` of the values lie, drawn linearly between the two nearest ranks.

    None where there is no value.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must lie between 0 and 1")
    n = _known(df, column).count()
    if n == 0:
        return None
    # a float's product with a large count would lose the fraction
    place = Fraction(share) * (n - 1)
    low = place.numerator // place.denominator
    first, second = order_statistics(df, column, [low, min(low + 1, n - 1)])
    part = float(place - low)
    return first if first == second or part == 0 else first + (second - first) * part
