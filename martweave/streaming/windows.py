"""Windows emitted once, with late rows as an output of their own.

The engine's own windowed aggregation loses late rows without a trace.  Here a batch is merged
into stored totals of the open windows: sums and counts are combined before the shuffle, so a
company that sends a third of all rows is no hot key, and the state is one row per open window
and company.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as V
from ..plans.spend import merged_partials, window_partials, window_rows
from .spend import AT_ONCE


class WindowStore:
    """Open windows and the watermark after each batch, in two places written in turn.

    Batch n reads place (n - 1) % 2 and overwrites place n % 2; its mark is written last.  A
    batch that is run again therefore starts from what it started from the first time, and old
    states leave nothing behind.
    """

    def __init__(self, path: str):
        self.path = path

    def _at(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}-{number % 2}"

    def before(self, spark, number: int, schema) -> tuple[DataFrame, object]:
        """Open windows and watermark that batch `number` starts from."""
        if number == 0:
            return spark.createDataFrame([], schema), None
        mark = spark.read.schema("batch long, watermark timestamp").parquet(self._at("mark", number - 1)).first()
        if mark is None or mark.batch != number - 1:
            raise RuntimeError(f"{self.path} does not hold the windows of batch {number - 1}")
        return spark.read.schema(schema).parquet(self._at("open", number - 1)), mark.watermark

    def keep(self, open_windows: DataFrame, watermark, number: int) -> None:
        spark = open_windows.sparkSession
        open_windows.write.mode("overwrite").parquet(self._at("open", number))
        mark = spark.createDataFrame([(number, watermark)], "batch long, watermark timestamp")
        mark.coalesce(1).write.mode("overwrite").parquet(self._at("mark", number))


def write_windows_once(
    rows: DataFrame,
    path: str,
    late_path: str,
    state_path: str,
    checkpoint: str,
    time_col: str = "arrived_at",
    lateness: str = "0 seconds",
    size: str = V.SPEND_WINDOW,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window aggregates of scored rows, each emitted once, and the rows that came after that.

    The watermark is the latest time seen, less `lateness`.  A row is late if the watermark after
    the batches before its own has passed the end of its window: then the window was emitted and
    the row goes to `late_path`, with that end and that watermark.  A row without time belongs to
    no window and is late as well.  A window is emitted at the end of the batch in which the
    watermark reaches its end.  Every output goes to a folder of the batch's number.
    """
    store = WindowStore(state_path)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        schema = window_partials(batch, time_col, size).schema
        opened, watermark = store.before(spark, number, schema)
        passed = F.lit(watermark).cast("timestamp")
        placed = _with_end(batch, time_col, size).persist()
        try:
            late = F.col("window_end").isNull() | F.coalesce(F.col("window_end") <= passed, F.lit(False))
            placed.filter(late).withColumn("watermark", passed).write.mode("overwrite").parquet(f"{late_path}/batch={number}")
            fresh = window_partials(placed.filter(~late).drop("window_end"), time_col, size)
            merged = merged_partials(opened.unionByName(fresh)).persist()
            newest = placed.agg((F.max(time_col) - F.expr(f"interval {lateness}")).alias("t")).first().t
            reached = max([t for t in (watermark, newest) if t is not None], default=None)
            closed = F.coalesce(F.col("window.end") <= F.lit(reached).cast("timestamp"), F.lit(False))
            window_rows(merged.filter(closed)).write.mode("overwrite").parquet(f"{path}/batch={number}")
            store.keep(merged.filter(~closed), reached, number)
            merged.unpersist()
        finally:
            placed.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )


def _with_end(rows: DataFrame, time_col: str, size: str) -> DataFrame:
    """Rows with the end of their window, null for rows without time (which a window would drop)."""
    at = F.coalesce(F.col(time_col), F.lit(0).cast("timestamp"))
    return (
        rows.withColumn("_at", at)
        .withColumn("_window", F.window("_at", size))
        .withColumn("window_end", F.when(F.col(time_col).isNotNull(), F.col("_window.end")))
        .drop("_at", "_window")
    )
