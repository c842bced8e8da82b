"""Writes that refuse single rows: the bad rows are found and set aside, the rest goes on."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Put = Callable[[pa.RecordBatch], None]


def accepted_ranges(batch: pa.RecordBatch, put: Put) -> list[tuple[int, str | None]]:
    """(rows, reason) of consecutive runs of `batch`: written together (no reason), or one refused row.

    A run whose write fails is halved until the rows that fail are alone, so b bad rows of n cost
    some b log(n) writes more.  A row is blamed only if the store still takes nothing at all: if
    even a write without rows fails, the store is at fault and the error goes on.
    """
    found, waiting = [], [(0, batch.num_rows)]
    while waiting:
        low, size = waiting.pop()
        try:
            put(batch.slice(low, size))
            found.append((size, None))
        except Exception as problem:  # noqa: BLE001 - whatever the store raises is the reason
            if size == 1:
                put(batch.slice(0, 0))
                found.append((1, str(problem)))
            else:
                half = size // 2
                waiting += [(low + half, size - half), (low, half)]
    return found


def with_refusals(rows: DataFrame, put: Put, reason: str = "reason") -> DataFrame:
    """`rows`, each handed to `put` in its task, with the reason where the store refused it (else null).

    `put` gets Arrow batches of all columns and raises if any row of them cannot be written.  A
    task that is lost runs again, so `put` must replace by key, or only check and encode what a
    later write stores.  Nothing is shuffled or collected.
    """

    def task(batches):
        for batch in batches:
            runs = accepted_ranges(batch, put) if batch.num_rows else []
            reasons = [text for size, text in runs for _ in range(size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reasons, pa.string())], names=[*batch.schema.names, reason])

    if reason in rows.columns:
        raise ValueError(f"column {reason} is there already")
    return rows.mapInArrow(task, rows.select("*", F.lit(None).cast("string").alias(reason)).schema)
