"""Signals of a live monitor: how busy a company is, whether a category is new to it, time since its last payment.

Each batch is joined with what earlier batches left: the instants of each company within the
look-back, its newest instant, and the categories seen.  Instants are cut into time blocks that
carry their own lead-in, so a company that sends a third of all rows is spread over many tasks,
which the engine's keyed state (one task per company) would not do.  What is kept follows the
look-back and the number of companies and categories, not the length of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.velocity import MICROS, time_blocks, with_lead_in
from .spend import AT_ONCE
from .windows import WindowStore


def live_signals(
    batch: DataFrame, seen: DataFrame, company: str, stamp: str, tie: str, minutes: int, block_hours: int = 1
) -> DataFrame:
    """Rows of `batch` with `recent_count` and `seconds_since_last`.

    `seen` (`company`, `stamp`, `_n`) holds instants of earlier batches and how many rows each
    had.  `recent_count` is the number of rows within the last `minutes` up to and at the row's
    instant, the batch's own included.  `seconds_since_last` reaches back to the row before it,
    where rows of earlier batches precede those of the same instant and rows of one batch go by
    `tie`; it is null for the first.  Rows without time have neither.
    """
    span = minutes * 60 * MICROS
    block = time_blocks(span, block_hours)
    fresh = batch.withColumn("_n", F.lit(1).cast("bigint")).withColumn("_fresh", F.lit(True))
    timed = fresh.filter(F.col(stamp).isNotNull()).unionByName(
        seen.withColumn("_fresh", F.lit(False)), allowMissingColumns=True
    )
    placed = with_lead_in(timed, stamp, span, block)
    # the newest instant before a block stands at its start, with no weight of its own
    by_block = Window.partitionBy(company).orderBy("_block")
    newest = timed.groupBy(company, F.floor(F.unix_micros(stamp) / F.lit(block)).cast("bigint").alias("_block")).agg(
        F.max(F.unix_micros(stamp)).alias("_newest")
    )
    before = newest.select(
        company, "_block", F.lag("_newest").over(by_block).alias("_at"), F.lit(0).cast("bigint").alias("_n"), F.lit(False).alias("_fresh")
    ).filter(F.col("_at").isNotNull())
    inside = Window.partitionBy(company, "_block")
    judged = (
        placed.unionByName(before, allowMissingColumns=True)
        .withColumn("recent_count", F.sum("_n").over(inside.orderBy("_at").rangeBetween(-span, 0)))
        .withColumn("_last", F.lag("_at").over(inside.orderBy("_at", F.col("_fresh"), tie)))
        .filter(F.col("_fresh") & (F.col("_block") == F.col("_own")))
        .withColumn("seconds_since_last", (F.col("_at") - F.col("_last")) / F.lit(MICROS))
        .select(*batch.columns, "recent_count", "seconds_since_last")
    )
    return judged.unionByName(batch.filter(F.col(stamp).isNull()), allowMissingColumns=True)


def first_sights(batch: DataFrame, known: DataFrame, company: str, category: str, stamp: str, tie: str) -> DataFrame:
    """The pairs of `company` and `category` that `known` lacks, with the order (`_first`) of their first row.

    Rows go by time, those without time last, then by `tie`.  Missing values are values like
    others.  One row per pair leaves a task, whatever the share of a pair.
    """
    firsts = batch.groupBy(company, category).agg(F.min(_order(stamp, tie)).alias("_first"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (company, category)]
    return firsts.alias("f").join(known.alias("k"), same, "left_anti")


def _order(stamp: str, tie: str) -> Column:
    return F.struct(F.col(stamp).isNull().alias("untimed"), F.col(stamp).alias("at"), F.col(tie).alias("tie"))


def instants_left(seen: DataFrame, batch: DataFrame, company: str, stamp: str, oldest: Column) -> DataFrame:
    """Instants from `oldest` on and the newest of each company, with their rows counted."""
    fresh = batch.filter(F.col(stamp).isNotNull()).groupBy(company, stamp).agg(F.count(F.lit(1)).alias("_n"))
    counted = seen.unionByName(fresh).groupBy(company, stamp).agg(F.sum("_n").alias("_n"))
    newest = counted.groupBy(company).agg(F.max(F.struct(stamp, "_n")).alias("_top")).select(company, "_top.*")
    return counted.filter(F.col(stamp) >= oldest).unionByName(newest.filter(F.col(stamp) < oldest))


def write_signals(
    rows: DataFrame,
    path: str,
    state_path: str,
    checkpoint: str,
    company: str = "company_id",
    category: str = "vendor_category",
    stamp: str = "arrived_at",
    tie: str = "transaction_id",
    minutes: int = 60,
    lateness: str = "0 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Every row of the stream with its signals, as known when its batch was handled.

    Adds `recent_count`, `seconds_since_last`, `new_category` and `history_complete`.  Instants
    are forgotten once they are more than `minutes` behind the watermark, which is the latest
    time seen less `lateness`; a row older than the watermark may therefore miss some of its
    look-back and says so in `history_complete`.  Rows that were handled are not revised when an
    older one comes.  `tie` must tell rows apart; wholly equal rows share `new_category`.  A
    batch that is run again replaces its folder and starts from the same state.
    """
    instants, categories = WindowStore(f"{state_path}/instants"), WindowStore(f"{state_path}/categories")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fields = {f.name: f.dataType for f in batch.schema.fields}
        seen, watermark = instants.before(spark, number, _schema({company: fields[company], stamp: fields[stamp], "_n": "long"}))
        known, _ = categories.before(spark, number, _schema({company: fields[company], category: fields[category]}))
        batch.persist()
        try:
            sights = first_sights(batch, known, company, category, stamp, tie).persist()
            judged = live_signals(batch, seen, company, stamp, tie, minutes)
            same = [F.col(f"j.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (company, category)]
            first = _order(f"j.{stamp}", f"j.{tie}").eqNullSafe(F.col("s._first"))
            passed = F.lit(watermark).cast("timestamp")
            told = judged.alias("j").join(sights.alias("s"), same, "left").select(
                "j.*",
                (F.col("s._first").isNotNull() & first).alias("new_category"),
                F.coalesce(F.col(f"j.{stamp}") >= passed, F.col(f"j.{stamp}").isNotNull()).alias("history_complete"),
            )
            told.write.mode("overwrite").parquet(f"{path}/batch={number}")
            latest = batch.agg((F.max(stamp) - F.expr(f"interval {lateness}")).alias("t")).first().t
            reached = max([t for t in (watermark, latest) if t is not None], default=None)
            oldest = F.coalesce(F.lit(reached).cast("timestamp") - F.expr(f"interval {minutes} minutes"), F.lit(0).cast("timestamp"))
            instants.keep(instants_left(seen, batch, company, stamp, oldest), reached, number)
            categories.keep(known.unionByName(sights.select(company, category)), None, number)
            sights.unpersist()
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )


def _schema(fields: dict):
    from pyspark.sql.types import StructType

    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema
