"""Lookup of numbers in non-overlapping closed ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 65536
# how much wider the blocks of the next level are
WIDER = 16


def _levels(block: int) -> int:
    """Levels whose blocks fit 64-bit numbers."""
    return next(n for n in range(1, 64) if block * WIDER**n >= 1 << 62)


def range_lookup(
    rows: DataFrame,
    ranges: DataFrame,
    value: str,
    start: str,
    end: str,
    columns: Sequence[str],
    block: int = BLOCK,
    salts: int = 1,
) -> DataFrame:
    """Left join of `rows` to the range holding `value`.

    Both sides are keyed by blocks of consecutive numbers, which makes it an equi join.  A
    range is repeated for each block it touches; wide ranges use wider blocks (each level
    `WIDER` times the one before), so none touches more than `WIDER` + 1.  There is a join for
    each level that occurs, one or two as a rule.  Spark broadcasts the ranges when they are
    small enough by its own size check and shuffles by block otherwise.  For a block that
    holds a large share of all rows, `salts` > 1 spreads its rows over that many keys and
    repeats only the ranges.
    """
    span = F.col(end).cast("decimal(38,0)") - F.col(start).cast("decimal(38,0)")
    level = F.lit(0)
    for n in range(1, _levels(block)):
        level = F.when(span >= F.lit(block * WIDER**n).cast("decimal(38,0)"), n).otherwise(level)
    levelled = ranges.withColumn("_level", level)
    # a dozen numbers at most
    levels = sorted(r[0] for r in levelled.select("_level").distinct().collect())
    result = rows.withColumn("_found", F.lit(None).cast(f"struct<{_fields(ranges, columns)}>"))
    for n in levels:
        width = F.lit(block * WIDER**n).cast("bigint")

        def at(name: str, width=width):
            number = F.col(name).cast("bigint")
            return F.call_function("div", number - F.pmod(number, width), width)

        blocks = levelled.where(F.col("_level") == n).select(
            F.explode(F.transform(F.sequence(F.lit(0), (at(end) - at(start)).cast("int")), lambda i: at(start) + i)).alias("_block"),
            F.col(start).alias("_start"),
            F.col(end).alias("_end"),
            F.struct(*[F.col(c) for c in columns]).alias("_here"),
        )
        keyed = result.withColumn("_block", at(value))
        on = ["_block"]
        if salts > 1:
            blocks = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
            on.append("_salt")
        left, right = keyed.alias("l"), blocks.alias("r")
        test = F.col(f"l.{value}").between(F.col("r._start"), F.col("r._end"))
        for name in on:
            test = test & (F.col(f"l.{name}") == F.col(f"r.{name}"))
        result = left.join(right, test, "left").select(
            *[F.col(f"l.`{c}`") for c in rows.columns], F.coalesce("l._found", "r._here").alias("_found")
        )
    return result.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_found").getField(c).alias(c) for c in columns])


def _fields(ranges: DataFrame, columns: Sequence[str]) -> str:
    kinds = dict(ranges.dtypes)
    return ",".join(f"`{c}`:{kinds[c]}" for c in columns)
