"""First-fit allocation of places to seekers by rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import ranked


def match_by_rank(
    seekers: DataFrame,
    places: DataFrame,
    group: Sequence[str],
    seeker_order: Sequence[str],
    place_order: Sequence[str],
    place_columns: Sequence[str],
) -> DataFrame:
    """Gives the k-th seeker of a group the k-th place of that group.

    With both sides in a fixed order this equals filling the first place that is still free,
    seeker by seeker.  All seekers come back; `place_columns` are null for those left over.
    """
    queue = ranked(seekers, group, seeker_order, "_k")
    free = ranked(places, group, place_order, "_k").select(*group, "_k", *place_columns)
    return queue.join(free, [*group, "_k"], "left").drop("_k").select(*seekers.columns, *place_columns)
