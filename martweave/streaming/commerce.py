"""Streaming ingestion of shop topics: events are appended, orders upserted, the rest refused."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import read_stored, store_upsert
from ..plans.commerce import ORDER_SCHEMA, decoded_events, decoded_orders, enrich_events, refused, routed
from .isolation import Put, with_refusals

# process what is there and stop; a running service passes {"processingTime": "30 seconds"} or the like
AT_ONCE = {"availableNow": True}


def stored_orders(spark, path: str) -> DataFrame:
    return read_stored(spark, path, ORDER_SCHEMA)


def deduplicated(events: DataFrame, keys: list[str], stamp: str, lateness: str = "1 hour") -> DataFrame:
    """Events without repeats of the same keys; plain ingestion keeps repeats.

    Works on streams, where keys are forgotten once the watermark has passed them.
    """
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withWatermark(stamp, lateness).dropDuplicatesWithinWatermark(keys)


def _stored(rows: DataFrame, put: Put) -> DataFrame:
    """Routed records after the sound ones were handed to the store; `reason` tells what it refused."""
    sound = rows.filter(F.col("reason").isNull()).drop("doc", "reason")
    told = with_refusals(sound, put)
    # the document is of a type that does not leave the engine: it is decoded again behind the store
    back = routed(told.withColumnRenamed("reason", "_refusal"))
    back = back.withColumn("reason", F.coalesce("_refusal", "reason")).drop("_refusal")
    return rows.filter(F.col("reason").isNotNull()).unionByName(back)


def ingest(
    records: DataFrame,
    events_path: str,
    orders_path: str,
    refused_path: str,
    checkpoint: str,
    geo_ranges: DataFrame | None = None,
    trigger: dict | None = None,
    put: Put | None = None,
) -> StreamingQuery:
    """Offsets advance only after all three writes of a batch succeed.

    A batch that is run again replaces its own folders, so events are not doubled, and merges
    the same orders once more, which changes nothing.

    `put` writes sound records to an outside store in their tasks; a record it refuses goes to
    the refused ones with the store's error as reason and does not hold up the others.  If the
    store is down altogether the batch fails and its offsets stay.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = routed(batch)
        if put is not None:
            rows = _stored(rows, put)
        rows = rows.persist()
        try:
            enrich_events(decoded_events(rows), geo_ranges).write.mode("overwrite").parquet(
                f"{events_path}/batch={number}"
            )
            store_upsert(decoded_orders(rows), orders_path, ORDER_SCHEMA, "order_id", "position", "present")
            refused(rows).write.mode("overwrite").text(f"{refused_path}/batch={number}")
        finally:
            rows.unpersist()

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )
