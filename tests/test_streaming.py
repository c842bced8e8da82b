import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from conftest import SMALL
from martweave.catalog import streams
from martweave.functions.messages import parse_transactions, valid_rows
from martweave.plans.spend import spend_windows
from martweave.sources.readers import message_files, topic_files
from martweave.streaming import commerce as commerce_stream
from martweave.streaming import spend as spend_stream

from test_messages import EVENT, ORDER, text

START = dt.datetime(2024, 1, 1)


def messages(spark, place, batch, rows):
    df = spark.createDataFrame([(v, START + dt.timedelta(seconds=s)) for v, s in rows], "value string, arrived_at timestamp")
    df.coalesce(1).write.mode("append").parquet(f"{place}/in")
    assert batch >= 0


def windows(spark, place):
    rows = spend_stream.scored_stream(message_files(spark, f"{place}/in"))
    spend_stream.write_windows(rows, f"{place}/out", f"{place}/state").awaitTermination()
    return {(r.company_id, r.window_start): r for r in spark.read.parquet(f"{place}/out").collect()}


def test_windows_close_with_the_watermark_and_drop_late_rows(spark, folder):
    one = [(text(transaction_id="a", amount_usd=10), 10), (text(transaction_id="b", amount_usd=20.005), 299), (text(transaction_id="c"), 300)]
    messages(spark, folder, 0, one)
    assert set(windows(spark, folder)) == {("company_0001", "2024-01-01T00:00:00+00:00")}
    messages(spark, folder, 1, [(text(transaction_id="late"), 20), (text(transaction_id="d"), 900)])
    got = windows(spark, folder)
    assert set(got) == {("company_0001", "2024-01-01T00:00:00+00:00"), ("company_0001", "2024-01-01T00:05:00+00:00")}
    first = got[("company_0001", "2024-01-01T00:00:00+00:00")]
    assert (first.transaction_count, first.total_amount_usd, first.window_end) == (2, 30.01, "2024-01-01T00:05:00+00:00")


def test_stream_equals_batch(spark, folder):
    rows = [(text(transaction_id=str(i), company_id=f"c{i % 3}", amount_usd=i * 1000), i * 40) for i in range(50)]
    messages(spark, folder, 0, rows)
    streamed = windows(spark, folder)
    batch = spend_windows(
        spend_stream.scored(valid_rows(parse_transactions(spark.read.parquet(f"{folder}/in")))), "arrived_at"
    )
    expected = {(r.company_id, r.window_start): r for r in batch.collect() if r.window_end <= "2024-01-01T00:32:40"}
    assert streamed == expected and len(expected) > 10


def test_scored_and_refused_sinks(spark, folder):
    messages(spark, folder, 0, [(text(), 1), ("junk", 2), (text(amount_usd="x"), 3), (text(amount_usd=10000), 4)])
    source = message_files(spark, f"{folder}/in")
    for _ in range(2):  # the second run finds nothing new
        spend_stream.write_scored(source, f"{folder}/scored", f"{folder}/refused", f"{folder}/state").awaitTermination()
    scored = spark.read.parquet(f"{folder}/scored")
    assert scored.count() == 2 and scored.filter("rule_flag_count = 2").count() == 1
    assert set(spend_stream.SCORED_COLUMNS) <= set(scored.columns)
    refused = spark.read.json(f"{folder}/refused")
    assert {r.error for r in refused.collect()} == {"invalid JSON", "could not convert amount_usd to float: 'x'"}


def test_topics(spark, folder):
    first = {**ORDER, "shipping_address": {"city": "Lille"}}
    second = {**ORDER, "status": "shipped"}
    records = [
        ("events", json.dumps({**EVENT, "metadata": {"ip": "0.0.0.9", "user_agent": "Firefox"}}), 0),
        ("orders", json.dumps(first), 1),
        ("orders", json.dumps(second), 2),
        ("orders", "{}", 3),
        ("other", json.dumps(EVENT), 4),
    ]
    df = spark.createDataFrame([(t, v, o, START) for t, v, o in records], "topic string, value string, offset bigint, timestamp timestamp")
    df.write.parquet(f"{folder}/in")
    ranges = spark.createDataFrame([(0, 255, "Nowhere", "NW", "Null")], "range_start bigint, range_end bigint, country string, country_code string, city string")
    commerce_stream.ingest(
        topic_files(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/orders", f"{folder}/refused", f"{folder}/state", ranges
    ).awaitTermination()
    event = spark.read.parquet(f"{folder}/events").first()
    assert (event.metadata.country, event.metadata.browser) == ("Nowhere", "Firefox")
    order = commerce_stream.stored_orders(spark, f"{folder}/orders").first()
    assert (order.status, order.shipping_address.city) == ("shipped", "Lille")
    refused = spark.read.text(f"{folder}/refused").select(F.from_json("value", "original_topic string, reason string, failed_at string").alias("r")).select("r.*")
    assert {r.reason for r in refused.collect()} == {"missing required field: 'order_id'", "unexpected topic: other"}


def test_deduplicated(spark, folder):
    rows = [("a", START), ("b", START), ("a", START + dt.timedelta(minutes=5))]
    df = spark.createDataFrame([("events", v, i, t) for i, (v, t) in enumerate(rows)], "topic string, value string, offset bigint, timestamp timestamp")
    assert commerce_stream.deduplicated(df, ["value"], "timestamp").count() == 2
    df.coalesce(1).write.parquet(f"{folder}/in")
    stream = commerce_stream.deduplicated(topic_files(spark, f"{folder}/in"), ["value"], "timestamp")
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    assert {r.value for r in spark.read.parquet(f"{folder}/out").collect()} == {"a", "b"}


def test_event_time_windows(spark, folder):
    """Windows by the transaction's own time when that column is named."""
    texts = [text(transaction_id=str(i), timestamp=f"2024-01-01T00:0{i}:00+00:00") for i in range(9)]
    messages(spark, folder, 0, [(t, 0) for t in texts])
    rows = spend_stream.scored_stream(message_files(spark, f"{folder}/in"))
    timed = rows.withColumn("occurred_at", F.col("timestamp").cast("timestamp"))
    spend_stream.write_windows(timed, f"{folder}/out", f"{folder}/state", time_col="occurred_at").awaitTermination()
    got = spark.read.parquet(f"{folder}/out").collect()
    assert [(r.window_start, r.transaction_count) for r in got] == [("2024-01-01T00:00:00+00:00", 5)]


def test_registered_streams_take_several_batches(spark, folder):
    seen = []

    def look(batch, number):
        seen.append(batch.agg(F.count("value"), F.min("arrived_at"), F.max("arrived_at")).first())

    for stream in streams._arrivals(spark, SMALL, folder):
        stream.writeStream.foreachBatch(look).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == streams.DELIVERIES and sum(r[0] for r in seen) == streams.S.MESSAGES.frame(spark, SMALL).count()
    assert all(a[2] < b[1] for a, b in zip(seen, seen[1:], strict=False))


def test_a_batch_run_again_replaces_its_rows(spark, folder):
    messages(spark, folder, 0, [(text(transaction_id="a"), 1), ("junk", 2)])
    for n in range(2):  # as after a failure between the write and the commit
        if n:
            for name in ("0", ".0.crc"):
                Path(f"{folder}/state/commits/{name}").unlink(missing_ok=True)
        source = message_files(spark, f"{folder}/in")
        query = spend_stream.write_scored(source, f"{folder}/scored", f"{folder}/refused", f"{folder}/state")
        query.awaitTermination()
        assert [p["batchId"] for p in query.recentProgress if p["numInputRows"]] == [0]
        assert spark.read.parquet(f"{folder}/scored").count() == 1
        assert spark.read.json(f"{folder}/refused").count() == 1


def test_a_delivery_of_a_table_in_one_file_is_dealt_to_all_tasks(spark, folder):
    """A table in order of time, in one file of one row group: what is delivered lies in a file per task."""
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.pmod("id", F.lit(40)).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 7}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    seen = []
    tasks = 2 * spark.sparkContext.defaultParallelism
    for n, _ in enumerate(streams._arrivals(spark, folder, folder)):
        files = spark.read.parquet(f"{folder}/in").groupBy(F.input_file_name()).count().collect()
        seen.append([r["count"] for r in files])
        assert len(files) == (n + 1) * tasks
    assert sum(seen[-1]) == 4000 and max(seen[-1]) < 4000 / streams.DELIVERIES / 4
