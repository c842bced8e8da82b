"""Data-quality checks folded into one aggregate per table.

A suite is a list of checks.  All row-wise checks of a table share a single scan; only
uniqueness and references need a shuffle of their own.  Every suite yields rows of
(table, check, column, observed, unexpected, success).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table", "check", "column", "observed", "unexpected", "success"]


@dataclass(frozen=True)
class Check:
    """One row-wise check: aggregates giving the observed value and the unexpected count, and a verdict."""

    name: str
    column: str
    observed: Column
    unexpected: Column
    passes: object = field(repr=False)  # (observed, unexpected) -> Column


def _share(good: Column, all_rows: Column) -> Column:
    return F.coalesce(F.try_divide(good, all_rows), F.lit(1.0)).cast("double")


def _rowwise(name: str, column: str, good: Column, counted: Column, mostly: float) -> Check:
    """Check passed by a row when `good`; rows outside `counted` are ignored."""
    good_rows = F.count_if(counted & F.coalesce(good, F.lit(False)))
    return Check(
        name,
        column,
        _share(good_rows, F.count_if(counted)),
        F.count_if(counted & ~F.coalesce(good, F.lit(False))),
        lambda seen, bad: seen >= mostly,
    )


def not_null(column: str) -> Check:
    return _rowwise("not_null", column, F.col(column).isNotNull(), F.lit(True), 1.0)


def required(column: str) -> Check:
    return _rowwise("required", column, F.col(column).isNotNull(), F.lit(True), 1.0)


def not_null_proportion(column: str, at_least: float) -> Check:
    return _rowwise("not_null_proportion", column, F.col(column).isNotNull(), F.lit(True), at_least)


def accepted_values(column: str, values: Sequence, mostly: float = 1.0) -> Check:
    return _rowwise("accepted_values", column, F.col(column).isin(*values), F.col(column).isNotNull(), mostly)


def between(column: str, low=None, high=None, mostly: float = 1.0) -> Check:
    value = F.col(column)
    good = F.lit(True)
    if low is not None:
        good = good & (value >= low)
    if high is not None:
        good = good & (value <= high)
    return _rowwise("between", column, good, value.isNotNull(), mostly)


def minimum(column: str, low) -> Check:
    return _rowwise("minimum", column, F.col(column) >= low, F.col(column).isNotNull(), 1.0)


def pair_at_least(a: str, b: str, or_equal: bool = True, mostly: float = 1.0) -> Check:
    left, right = F.col(a), F.col(b)
    good = left >= right if or_equal else left > right
    return _rowwise("pair_at_least", f"{a},{b}", good, left.isNotNull() & right.isNotNull(), mostly)


def has_type(column: str, sql_type: str) -> Check:
    """Whether stored text reads as the given type."""
    good = F.col(column).cast("string").try_cast(sql_type).isNotNull()
    return _rowwise(f"type_{sql_type}", column, good, F.col(column).isNotNull(), 1.0)


def holds(name: str, column: str, test: Column) -> Check:
    """Any boolean rule; rows for which it is unknown fail."""
    return _rowwise(name, column, test, F.lit(True), 1.0)


def row_count_between(low: int, high: int) -> Check:
    return Check(
        "row_count_between", "", F.count(F.lit(1)).cast("double"), F.lit(0).cast("bigint"),
        lambda seen, bad: seen.between(low, high),
    )


def mean_between(column: str, low: float, high: float) -> Check:
    return Check(
        "mean_between", column, F.avg(column).cast("double"), F.lit(0).cast("bigint"),
        lambda seen, bad: F.coalesce(seen.between(low, high), F.lit(False)),
    )


def run_rowwise(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks in one aggregate, then one row per check."""
    one = df.agg(
        *[c.observed.alias(f"o{i}") for i, c in enumerate(checks)],
        *[c.unexpected.cast("bigint").alias(f"u{i}") for i, c in enumerate(checks)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.round(F.col(f"o{i}"), 6).alias("observed"),
                F.col(f"u{i}").alias("unexpected"),
                F.coalesce(c.passes(F.col(f"o{i}"), F.col(f"u{i}")), F.lit(False)).alias("success"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return one.select(F.inline(rows))


def _verdict(df: DataFrame, table: str, name: str, column: str, observed, unexpected, success) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"),
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        F.round(observed.cast("double"), 6).alias("observed"),
        unexpected.cast("bigint").alias("unexpected"),
        success.alias("success"),
    )


def run_unique(table: str, df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored.  Counts combine before the shuffle."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    one = counts.agg(F.count_if(F.col("n") > 1).alias("bad"))
    return _verdict(one, table, "unique", column, F.col("bad"), F.col("bad"), F.col("bad") == 0)


def run_unique_proportion(table: str, df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    one = counts.agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))
    share = F.coalesce(F.try_divide(F.col("values"), F.col("rows")), F.lit(1.0))
    return _verdict(
        one, table, "unique_proportion_between", column, share, F.lit(0), share.between(low, high)
    )


def run_relationship(table: str, df: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Non-null values with no row in the parent."""
    child = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("_v"))
    keys = parent.select(F.col(field_name).alias("_v"))
    one = child.join(keys, "_v", "left_anti").agg(F.count(F.lit(1)).alias("bad"))
    return _verdict(one, table, "relationship", column, F.col("bad"), F.col("bad"), F.col("bad") == 0)


def run_singular(name: str, offending: DataFrame) -> DataFrame:
    """A test given as the rows that break it."""
    one = offending.agg(F.count(F.lit(1)).alias("bad"))
    return _verdict(one, name, "singular", "", F.col("bad"), F.col("bad"), F.col("bad") == 0)


def union_results(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def overall(results: DataFrame) -> DataFrame:
    """One row: whether every check passed, and how many did not."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count_if(~F.col("success")).alias("failed_checks"),
        F.count(F.lit(1)).alias("checks"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would break a unique index, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
