"""Several distinct counts per group without repeating every row once per count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_distinct_counts(
    df: DataFrame,
    group: Sequence[str],
    counted: Mapping[str, str],
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
) -> DataFrame:
    """Per `group` the number of distinct non-null values of each column of `counted` (name to
    column) and the `final` aggregates over the `partial` ones.

    Rows are first combined to one per group and combination of the counted columns, before
    and after a shuffle.
    """
    return from_partials(distinct_partials(df, group, counted, partial), group, counted, final)


def distinct_partials(
    df: DataFrame, group: Sequence[str], counted: Mapping[str, str], partial: Mapping[str, Column]
) -> DataFrame:
    """One row per group and combination of the counted columns, with the `partial` aggregates."""
    return df.groupBy(*group, *counted.values()).agg(*[e.alias(n) for n, e in partial.items()])


def from_partials(
    partials: DataFrame, group: Sequence[str], counted: Mapping[str, str], final: Mapping[str, Column]
) -> DataFrame:
    """Counts and `final` aggregates from the partial rows of one or several lots of input.

    The first row of each value of a group is marked, in the tasks of that value, and the marks
    are summed with everything else; no task holds all values of a group.
    """
    columns, marked = list(counted.values()), partials
    for name, column in counted.items():
        others = [c for c in columns if c != column]
        in_value = Window.partitionBy(*group, column).orderBy(*(others or [column]))
        first = (F.row_number().over(in_value) == 1) & F.col(column).isNotNull()
        marked = marked.withColumn(f"_is_{name}", first.cast("long"))
    counts = [F.sum(f"_is_{name}").alias(name) for name in counted]
    return marked.groupBy(*group).agg(*counts, *[e.alias(n) for n, e in final.items()])
