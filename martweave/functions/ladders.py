"""Threshold ladders, word-group classifiers and literal lookups as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def at_least(value, rungs: Iterable[tuple], default, extra: Column | None = None) -> Column:
    """Result of the first rung whose threshold `value` reaches, else `default`."""
    value = as_col(value)
    chain = F
    for threshold, result in rungs:
        test = value >= F.lit(threshold)
        if extra is not None:
            test = test & extra
        chain = chain.when(test, F.lit(result))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def member_of(value, groups: Iterable[tuple], default) -> Column:
    """Result of the first group that lists `value`, else `default`."""
    value = as_col(value)
    chain = F
    for members, result in groups:
        chain = chain.when(value.isin(*members), F.lit(result))
    return chain.otherwise(F.lit(default))


def contains_any(value, groups: Iterable[tuple], default) -> Column:
    """Result of the first group one of whose fragments occurs in lower-cased `value`."""
    text = F.lower(as_col(value))
    chain = F
    for result, fragments in groups:
        test = F.lit(False)
        for fragment in fragments:
            test = test | text.contains(fragment)
        chain = chain.when(test, F.lit(result))
    return chain.otherwise(F.lit(default))


def lookup(value, table: Mapping, default) -> Column:
    """Literal map lookup; anything not in the map gives `default`."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[as_col(value)], F.lit(default))


def text_flag(test: Column) -> Column:
    """'TRUE' or 'FALSE' as text; an unknown test is 'FALSE'."""
    return F.when(test, F.lit("TRUE")).otherwise(F.lit("FALSE"))
