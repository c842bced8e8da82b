"""Shaping of the plan where the optimizer would repeat costly expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a column that is computed exactly once per row.

    A plain column is not: a later filter on anything derived from it is rewritten into one
    that repeats its expression per mention, and a branch of a conditional computes it anew.
    A generator over one element is left alone.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def once_all(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The same for several columns that do not depend on each other."""
    packed = once(df, F.struct(*[value.alias(name) for name, value in values.items()]), "_once")
    return packed.select(*df.columns, *[F.col(f"_once.{name}").alias(name) for name in values])
