"""Places along ordered rows, with no group gathered in one task.

`in_order` sorts rows by range and writes them once; each row knows its file and its place in it.
`running` cuts a group into blocks of places and carries the sum of a block on to the next, so a
group is many tasks however large it is, also where all of its rows are equal or none has an
order.  Only one row per block goes through a window over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import kept

BLOCK = 16384
# file and place in the file; the lower 33 bits of the engine's row ids count the rows of a task
FILE, PLACE = "_file", "_place"


def in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """`df`, sorted and kept, with `FILE` and `PLACE`.  A run of equal rows may span files."""
    row = F.monotonically_increasing_id()
    ranged = df.withColumn("_tie", row).orderBy(*order, "_tie").drop("_tie")
    return kept(ranged.withColumns({FILE: F.spark_partition_id(), PLACE: row.bitwiseAND(F.lit((1 << 33) - 1))}), label)


def running(df: DataFrame, group: Sequence[str], size: Column, name: str) -> DataFrame:
    """Adds the sum of `size` over the rows of the group up to and with this one.

    `df` comes from rows put `in_order`, each at most once a group, and is read twice.  A null
    in `group` is a value like others.
    """
    sized = df.withColumns({"_size": size, "_block": F.floor(F.col(PLACE) / F.lit(BLOCK))})
    keys = [*group, FILE, "_block"]
    earlier = Window.partitionBy(*group).orderBy(FILE, "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sized.groupBy(*keys).agg(F.sum("_size").alias("_total")).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    joined = sized.join(blocks, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return joined.select(*df.columns, (F.col("_before") + F.sum("_size").over(inside)).alias(name))
