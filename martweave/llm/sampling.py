"""Bounded samples drawn by hash, the same on every run and however the rows are dealt out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 40
# so many times the rows wanted, and some, pass the first cut: the chance of too few is negligible
_SPARE, _SOME = 3, 64


def drawn(df: DataFrame, key: str, wanted: int, total: int, seed: int) -> DataFrame:
    """`wanted` of the `total` rows of `df` (all, if fewer).

    A cut by hash comes first, so what is sorted follows the sample, not the table.
    """
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_SPACE))
    cut = min(1.0, (_SPARE * wanted + _SOME) / max(total, 1))
    return df.where(draw < int(cut * _SPACE)).orderBy(draw, key).limit(wanted)
