"""A mart with a row set per day that is kept up to date from mergeable partial rows.

A run combines its new rows to partial rows and stores them under their day and its own number.
Only days it brought rows for are made anew, from the partial rows of all runs, so neither old
input nor other days are read.  Partial rows are never changed: a run that failed halfway is run
again under its number and replaces what it left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import stored_or_none

_DAY, _RUN = "_day", "_run"


class DailyMart:
    """`partials` combines rows (keeping the column `day`), `finish` makes mart rows of partial ones.

    `finish` must give the same rows for partial rows of one lot and of the same input in several
    lots.  One writer is assumed, as are the same rows for a run that is run again.
    """

    def __init__(
        self, path: str, day: str, partials: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame]
    ):
        self.path, self.day, self.partials, self.finish = path, day, partials, finish

    def update(self, rows: DataFrame, run: int) -> list:
        """Takes in the rows of a run and returns the days made anew (None: rows without a day)."""
        spark = rows.sparkSession
        fresh = self.partials(rows).withColumn(_DAY, F.col(self.day)).withColumn(_RUN, F.lit(run))
        _put(fresh, f"{self.path}/partials", [_DAY, _RUN])
        # a row per calendar day at most; only names of folders are read
        stored = self._read(fresh.schema, spark)
        days = [r[0] for r in stored.filter(F.col(_RUN) == run).select(_DAY).distinct().collect()]
        if days:
            made = self.finish(_of_days(stored, days).drop(_DAY, _RUN)).withColumn(_DAY, F.col(self.day))
            _put(made, f"{self.path}/rows", [_DAY])
        return sorted(days, key=str)

    def _read(self, schema, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/partials")

    def rows(self, spark: SparkSession) -> DataFrame | None:
        """The mart as it stands, None before the first row."""
        stored = stored_or_none(spark, f"{self.path}/rows")
        return None if stored is None else stored.drop(_DAY)


def _put(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces the folders that `df` has rows for; days of many rows are split over tasks and files, small ones share a task."""
    df.hint("rebalance", *by).write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _of_days(stored: DataFrame, days: Sequence) -> DataFrame:
    """Rows of these days; the folders of others are not opened."""
    known = [d for d in days if d is not None]
    test = F.col(_DAY).isin(known)
    return stored.filter(test | F.col(_DAY).isNull() if len(known) < len(days) else test)
