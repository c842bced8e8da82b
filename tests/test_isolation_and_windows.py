"""Refused writes and late rows: nothing is lost, nothing is doubled."""

import datetime as dt
import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martweave.sources.readers import topic_files
from martweave.streaming import commerce as commerce_stream
from martweave.streaming.isolation import accepted_ranges, with_refusals
from martweave.streaming.windows import WindowStore, write_windows_once
from test_messages import EVENT, ORDER

START = dt.datetime(2024, 1, 1)
SCORED = "company_id string, company_name string, company_size_tier string, amount_usd double, risk_flag boolean, arrived_at timestamp"


def refusing(bad, calls=None):
    def put(batch):
        if calls is not None:
            calls.append(batch.num_rows)
        hit = sorted(set(batch.column("n").to_pylist()) & set(bad))
        if hit:
            raise ValueError(f"refused {hit[0]}")

    return put


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 300), st.sets(st.integers(0, 299), max_size=5))
def test_bad_rows_are_found_alone(size, bad):
    calls = []
    batch = pa.RecordBatch.from_pydict({"n": list(range(size))})
    runs = accepted_ranges(batch, refusing(bad, calls))
    reasons = [text for n, text in runs for _ in range(n)]
    assert reasons == [f"refused {i}" if i in bad else None for i in range(size)]
    there = len([b for b in bad if b < size])
    assert len(calls) <= 1 + there * (2 * size.bit_length() + 3)


def test_a_store_that_is_down_blames_no_row():
    def down(batch):
        raise OSError("no connection")

    with pytest.raises(OSError):
        accepted_ranges(pa.RecordBatch.from_pydict({"n": [1, 2, 3]}), down)


def test_refusals_of_a_frame(spark):
    rows = spark.range(1000).select(F.col("id").alias("n")).repartition(7)
    told = with_refusals(rows, refusing({3, 500, 501}))
    assert {r.n: r.reason for r in told.where("reason is not null").collect()} == {i: f"refused {i}" for i in (3, 500, 501)}
    assert told.count() == 1000 and with_refusals(rows.limit(0), refusing({})).count() == 0
    with pytest.raises(ValueError):
        with_refusals(told, refusing({}))


def test_ingestion_sets_refused_writes_aside(spark, folder):
    def record(topic, doc, offset):
        return topic, json.dumps(doc), 0, offset, START

    rows = [record("events", dict(EVENT, user_id=f"u{i}"), i) for i in range(30)]
    rows += [record("orders", dict(ORDER, order_id=f"o{i}"), 100 + i) for i in range(10)] + [("events", "junk", 0, 500, START)]
    spark.createDataFrame(rows, "topic string, value string, partition int, offset long, timestamp timestamp").write.parquet(f"{folder}/in")

    def put(batch):
        for offset in batch.column("offset").to_pylist():
            if offset in (7, 8, 105):
                raise ValueError(f"cannot write {offset}")

    def run(store):
        commerce_stream.ingest(
            topic_files(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/orders", f"{folder}/refused", f"{folder}/state", put=store
        ).awaitTermination()

    def down(batch):
        raise OSError("no connection")

    with pytest.raises(Exception, match="no connection"):
        run(down)
    run(put)  # the same batch, whole
    run(put)  # nothing new
    users = {r.user_id for r in spark.read.parquet(f"{folder}/events").collect()}
    assert users == {f"u{i}" for i in range(30)} - {"u7", "u8"}
    orders = {r.order_id for r in commerce_stream.stored_orders(spark, f"{folder}/orders").collect()}
    assert orders == {f"o{i}" for i in range(10)} - {"o5"}
    letters = [json.loads(r.value) for r in spark.read.text(f"{folder}/refused").collect()]
    assert sorted(x["reason"] for x in letters) == ["cannot write 105", "cannot write 7", "cannot write 8", "invalid JSON"]
    assert {json.loads(x["original_value"]).get("user_id") for x in letters if x["reason"] == "cannot write 7"} == {"u7"}


def deliver(spark, folder, rows, **options):
    data = [(c, f"name {c}", None, float(a), False, None if s is None else START + dt.timedelta(seconds=s)) for c, a, s in rows]
    spark.createDataFrame(data, SCORED).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCORED).parquet(f"{folder}/in")
    write_windows_once(stream, f"{folder}/out", f"{folder}/late", f"{folder}/open", f"{folder}/state", **options).awaitTermination()


def emitted(spark, folder):
    return sorted((r.company_id, r.window_start[11:16], r.transaction_count, r.total_amount_usd) for r in spark.read.parquet(f"{folder}/out").collect())


def late(spark, folder):
    rows = spark.read.parquet(f"{folder}/late").collect()
    return sorted(((r.company_id, r.amount_usd, r.window_end and r.window_end.strftime("%H:%M")) for r in rows), key=str)


def test_late_rows_are_an_output(spark, folder):
    deliver(spark, folder, [("a", 1, 10), ("a", 2, 299), ("b", 3, 5), ("a", 4, 650)])
    assert set(emitted(spark, folder)) == {("a", "00:00", 2, 3.0), ("b", "00:00", 1, 3.0)}
    assert late(spark, folder) == []
    # 00:00 is emitted, 00:05 as well (the watermark is at 00:10:50); 00:10 is open
    deliver(spark, folder, [("a", 5, 20), ("b", 6, 599), ("a", 7, 640), ("c", 8, None), ("a", 9, 900)])
    assert late(spark, folder) == sorted([("a", 5.0, "00:05"), ("b", 6.0, "00:10"), ("c", 8.0, None)], key=str)
    assert ("a", "00:10", 2, 11.0) in emitted(spark, folder)
    assert [r for r in emitted(spark, folder) if r[0] == "b"] == [("b", "00:00", 1, 3.0)]


def test_allowed_lateness_keeps_windows_open(spark, folder):
    deliver(spark, folder, [("a", 1, 10), ("a", 2, 650)], lateness="10 minutes")
    deliver(spark, folder, [("a", 4, 20), ("a", 8, 1300)], lateness="10 minutes")
    assert late(spark, folder) == [] and emitted(spark, folder)[0] == ("a", "00:00", 2, 5.0)


def test_a_batch_run_again_replaces_its_rows(spark, folder):
    from martweave.plans.spend import window_partials

    rows = spark.createDataFrame([("a", "n", None, 1.0, False, START)], SCORED)
    store = WindowStore(f"{folder}/open")
    partials = window_partials(rows, "arrived_at")
    store.keep(partials, START, 0)
    for _ in range(2):
        opened, mark = store.before(spark, 1, partials.schema)
        assert opened.count() == 1 and mark == START
        store.keep(opened.limit(0), START + dt.timedelta(hours=1, microseconds=7), 1)
    assert store.before(spark, 2, partials.schema)[1] == START + dt.timedelta(hours=1, microseconds=7)
    with pytest.raises(RuntimeError):
        store.before(spark, 3, partials.schema)
