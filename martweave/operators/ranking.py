"""Top rows per group, pages and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import page_count


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """First `n` rows of each group.

    The rank filter reaches the shuffle as a per-task group limit, so a hot group sends at
    most `n` rows per task.
    """
    name = rank or "_rank"
    picked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(
        F.col(name) <= n
    )
    return picked if rank else picked.drop(name)


def page(df: DataFrame, order: Sequence, number: int, size: int) -> DataFrame:
    """One page of the ordered rows, the first page being 1.

    Keeps `number * size` rows at the end; for deep pages go on from the last key: `page_after`.
    """
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The `size` rows that follow the row with the key values `last` (None: the first rows).

    Rows are ordered by `keys`, ascending, nulls first; `keys` must be unique.  However deep the
    page, only `size` rows are kept per task and on the driver, and the filter reaches the scan.
    """
    if last is not None:
        after = F.lit(False)
        for key, value in reversed(list(zip(keys, last, strict=True))):
            column = F.col(key)
            if value is None:
                after = column.isNotNull() | (column.isNull() & after)
            else:
                after = (column > F.lit(value)) | ((column == F.lit(value)) & after)
        df = df.filter(F.coalesce(after, F.lit(False)))
    return df.orderBy(*keys).limit(size)


def page_totals(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_items")).withColumn(
        "total_pages", page_count("total_items", size)
    )
