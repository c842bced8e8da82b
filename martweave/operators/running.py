"""Ranks and running totals that stay spread over tasks when one group is huge.

A plain window sorts a whole group in one task.  Here a group is cut into chunks along an
integer order column; only chunk totals (one row per chunk) are accumulated per group, and
each chunk adds its own offset.  The chunk of a row depends on its data alone, so a
recomputed task lands on the same chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_WIDTH = 65536


def _before(value: str, window: Window):
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _offsets(totals: DataFrame, group: Sequence[str], names: Sequence[str], width: int) -> DataFrame:
    """Sum of all earlier chunks of the group, per chunk.

    Chunks are accumulated within spans of `width` chunks and spans within the group, so
    that also thinly used order values (a time in microseconds) leave little to any one task.
    """
    chunks = totals.withColumn("_span", F.floor(F.col("_chunk") / F.lit(width)).cast("bigint"))
    keys = [*group, "_span"]
    spans = chunks.groupBy(*keys).agg(*[F.sum(f"_sum_{n}").alias(f"_all_{n}") for n in names])
    in_group = Window.partitionBy(*group).orderBy("_span")
    bases = spans.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], *[_before(f"_all_{n}", in_group).alias(f"_base_{n}") for n in names]
    )
    in_span = Window.partitionBy(*keys).orderBy("_chunk")
    same_span = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    return chunks.join(bases, same_span, "inner").select(
        *[F.col(k).alias(f"_o_{k}") for k in [*group, "_chunk"]],
        *[(F.col(f"_base_{n}") + _before(f"_sum_{n}", in_span)).alias(f"_off_{n}") for n in names],
    )


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Adds, per entry of `sums`, the running sum within `group` in `order`, this row included.

    `order[0]` must be an integer column; `width` consecutive values of it form a chunk.
    `df` is read twice, once for the chunk totals: `session.pin` a costly one first.
    """
    chunked = df.withColumns({f"_add_{n}": e for n, e in sums.items()}).withColumn(
        "_chunk", F.floor(F.col(order[0]) / F.lit(width)).cast("bigint")
    )
    keys = [*group, "_chunk"]
    totals = chunked.groupBy(*keys).agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in sums])
    offsets = _offsets(totals, group, list(sums), width)
    same_chunk = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = chunked.join(offsets, same_chunk, "inner")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_off_{n}") + F.coalesce(F.sum(f"_add_{n}").over(inside), F.lit(0))).alias(n)
            for n in sums
        ],
    )


def ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank", width: int = CHUNK_WIDTH
) -> DataFrame:
    """Adds the 1-based position within `group`; `order` must be unique within a group."""
    return running_sums(df, group, order, {name: F.lit(1).cast("bigint")}, width)


def numbered_by_content(df: DataFrame, order: Sequence[str], name: str = "row_no", label: str = "sorted") -> DataFrame:
    """Adds consecutive numbers from 1 in the global order of `order`.

    The sorted rows are written once; the number is the size of all earlier files plus the
    position in the row's own file.  No single task sees more than one sort range.  Equal
    rows may take each other's numbers; a trailing tie-breaker lets the range split cut
    through a large run of equal rows.
    """
    from ..session import run_folder

    spark = df.sparkSession
    path = run_folder(spark, label)
    spread = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = spread.orderBy(*order, "_tie").drop("_tie")
    ranged.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return stored.join(offsets, "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(name), *df.columns
    )


def next_ids(
    df: DataFrame, order: Sequence[str], start: Column, prefix: str, digits: int, name: str, width: int = CHUNK_WIDTH
) -> DataFrame:
    """Adds consecutive padded ids continuing after the number `start`."""
    numbered = ranked(df, [], order, "_n", width)
    number = (F.col("_n") + start).cast("string")
    # a number longer than the padding must not be cut
    padded = F.when(F.length(number) < digits, F.lpad(number, digits, "0")).otherwise(number)
    return numbered.withColumn(name, F.concat(F.lit(prefix), padded)).drop("_n")
