"""Sliding windows from panes: a row is counted once, however many windows cover it.

A pane is as long as the greatest common divisor of window and slide.  Rows are combined per pane
first.  A window of k panes then lies in two neighbouring blocks of k panes: it is the tail of one
and the head of the next, so its totals are a running total from the end of the first and one from
the start of the second.  No window function spans more than two blocks of a key, and each of its
steps costs the same whatever k is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 604800 * 10**6}

# how totals of two sets of rows become the total of both
MERGES = {"sum": lambda a, b: a + b, "min": lambda a, b: F.least(a, b), "max": lambda a, b: F.greatest(a, b)}
_EVENTS = "array<struct<_place:int,_start:boolean>>"
_RUNNING = {"sum": F.sum, "min": F.min, "max": F.max}


def micros(duration: str) -> int:
    """Length of a duration such as '10 minutes' or '1 day 6 hours'; units that vary in length are refused."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", duration.strip().lower())
    if not parts or any(unit not in _UNITS for _, unit in parts):
        raise ValueError(f"no fixed length: {duration}")
    return sum(int(n) * _UNITS[unit] for n, unit in parts)


def sliding_totals(
    rows: DataFrame,
    stamp: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    totals: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Per sliding window (`window`, as the engine's own) and keys the `totals`.

    A total is its way of merging (a name in `MERGES`) and the aggregate over rows, e.g.
    `("sum", F.count(F.lit(1)))`.  Windows start at multiples of `slide`; those without a row
    are left out, as are rows without time.  Missing key values make a group of their own.
    """
    length, step = micros(size), micros(slide)
    if step > length:
        raise ValueError("windows with gaps between them need no panes")
    pane = math.gcd(length, step)
    k, names = length // pane, list(totals)
    at = F.floor(F.unix_micros(stamp) / F.lit(pane)).cast("bigint")
    panes = rows.filter(F.col(stamp).isNotNull()).groupBy(*keys, at.alias("_pane")).agg(
        *[value.alias(name) for name, (_, value) in totals.items()]
    )
    # a pane ends windows that start in its block and goes on with those that start one block earlier
    block, place = F.floor(F.col("_pane") / F.lit(k)).cast("bigint"), F.pmod(F.col("_pane"), F.lit(k)).cast("int")
    roles = F.array(
        F.struct(block.alias("_block"), F.lit(False).alias("_next")), F.struct((block - 1).alias("_block"), F.lit(True).alias("_next"))
    )
    placed = panes.withColumn("_place", place).withColumn("_role", F.explode(roles)).select(*keys, "_role.*", "_place", *names)
    inside = Window.partitionBy(*keys, "_block")
    # a window holds a row if it starts no later than the last pane of its block or after the first one of the next;
    # the first row of a block brings all starts, so the panes are read once
    last, first = F.max(F.when(~F.col("_next"), F.col("_place"))), F.min(F.when(F.col("_next"), F.col("_place")))
    ends = placed.withColumns(
        {
            "_last": last.over(inside),
            "_first": first.over(inside),
            "_leads": F.row_number().over(inside.orderBy("_place", "_next")) == 1,
        }
    )
    held = F.filter(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda p: (F.coalesce(p <= F.col("_last"), F.lit(False)) | F.coalesce(p > F.col("_first"), F.lit(False)))
        & (F.pmod((F.col("_block") * k + p) * pane, F.lit(step)) == 0),
    )
    starts = F.when(F.col("_leads"), F.transform(held, lambda p: F.struct(p.alias("_place"), F.lit(True).alias("_start"))))
    itself = F.array(F.struct(F.col("_place"), F.lit(False).alias("_start")))
    events = ends.withColumn("_event", F.explode(F.concat(itself, F.coalesce(starts, F.array().cast(_EVENTS))))).select(
        *keys, "_block", "_next", "_event.*", *names
    )
    tail = inside.orderBy(F.desc("_place")).rangeBetween(Window.unboundedPreceding, 0)
    head = inside.orderBy("_place").rangeBetween(Window.unboundedPreceding, -1)

    def over(name: str, following: bool, window) -> Column:
        own = F.when(~F.col("_start") & (F.col("_next") == following), F.col(name))
        return _RUNNING[totals[name][0]](own).over(window)

    summed = events.select(
        *keys, "_block", "_place", "_start",
        *[over(n, False, tail).alias(f"_tail_{n}") for n in names],
        *[over(n, True, head).alias(f"_head_{n}") for n in names],
    )
    start = (F.col("_block") * k + F.col("_place")) * pane
    window = F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + length).alias("end"))
    kinds = dict(panes.dtypes)
    return summed.filter("_start").select(
        window.alias("window"),
        *keys,
        *[_merged(totals[n][0], F.col(f"_tail_{n}"), F.col(f"_head_{n}")).cast(kinds[n]).alias(n) for n in names],
    )


def _merged(kind: str, a: Column, b: Column) -> Column:
    return F.coalesce(MERGES[kind](a, b), a, b)
