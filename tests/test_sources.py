import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martweave import session
from martweave.sources import readers, sinks


def test_csv_and_rates(spark, folder):
    with open(folder + "/hotels.csv", "w") as f:
        f.write("hotel_id,hotel_type,hotel_name,region,country,is_active\nH1,City Hotel,One,EU,FR,True\n")
    seed = readers.csv_seed(spark, folder + "/hotels.csv", readers.HOTEL_SEED_SCHEMA).first()
    assert seed.hotel_name == "One" and seed.is_active is True
    texts = readers.csv_text_rows(spark, folder + "/hotels.csv", ["hotel_id", "hotel_type", "hotel_name", "region", "country", "is_active"])
    assert texts.first().is_active == "True"
    with open(folder + "/rates.json", "w") as f:
        json.dump([{"currency_pair": "USD/EUR", "rate": 0.95}, {"currency_pair": "EUR/USD", "rate": 1.05}], f, indent=1)
    rates = readers.exchange_rates(spark, folder + "/rates.json", "2024-01-01 00:00:00").collect()
    assert {(r.currency_pair, r.exchange_rate) for r in rates} == {("USD/EUR", 0.95), ("EUR/USD", 1.05)}


def test_materialisation(spark, folder):
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    assert sinks.rebuild(df, folder + "/t", "p").count() == 5
    assert sinks.rebuild(df.limit(2), folder + "/t", "p").count() == 2
    sinks.as_view(df, "five")
    assert spark.sql("select count(*) n from five").first().n == 5


def test_high_water_mark_reaches_the_scan(spark, folder):
    source = spark.createDataFrame([(i, dt.date(2024, 1, i + 1)) for i in range(10)], "id int, day date")
    source.write.parquet(folder + "/source")
    stored = spark.read.parquet(folder + "/source")
    newer = sinks.newer_rows(stored, stored.filter("id < 5"), "day")
    assert newer.count() == 5
    assert "GreaterThan(day,2024-01-05)" in newer._jdf.queryExecution().executedPlan().toString()
    assert sinks.newer_rows(stored, stored.limit(0), "day").count() == 10


def test_audit_append(spark, folder):
    from martweave.plans import spend

    rows = spark.createDataFrame([("2024-01-02",)], "timestamp string")
    entry = spend.audit_entry(spend.retrain_decision(rows, spend.last_retrain(sinks.stored_or_none(spark, folder + "/audit"))))
    sinks.append(entry, folder + "/audit")
    sinks.append(entry, folder + "/audit")
    assert spark.read.parquet(folder + "/audit").count() == 2
    assert spend.last_retrain(sinks.stored_or_none(spark, folder + "/audit")) > "2024"


def test_retention(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-03-30T00:00:00Z",), ("bad",)], "timestamp string")
    from martweave.plans.commerce import event_time

    kept, expired = sinks.expire(rows, event_time(), "2024-04-01 00:00:00", 90)
    assert {r.timestamp for r in kept.collect()} == {"2024-03-30T00:00:00Z", "bad"} and expired.count() == 1


def test_row_counts_go_on_after_an_error(spark):
    got = {r.table: r for r in sinks.row_counts(spark, {"a": spark.range(3), "b": lambda: spark.table("nope"), "c": lambda: spark.range(1)}).collect()}
    assert got["a"].rows == 3 and got["b"].rows is None and got["b"].error and got["c"].rows == 1


def test_row_counts_go_on_where_a_table_fails_while_it_is_read(spark):
    broken = spark.range(3).select(F.raise_error(F.lit("lost " + "x" * 300)).alias("v")).where("v is null")
    got = {r.table: r for r in sinks.row_counts(spark, {"a": broken, "b": spark.range(2)}).collect()}
    assert got["a"].rows is None and "x" * 300 in got["a"].error and got["b"].rows == 2


def test_only_a_missing_table_is_a_first_run(spark, folder):
    assert sinks.stored_or_none(spark, f"{folder}/none") is None
    (Path(folder) / "bad").mkdir()
    (Path(folder) / "bad" / "part-0.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception):  # noqa: B017
        sinks.append_newer(spark.range(3), f"{folder}/bad", "id")


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    place = session.run_folder(spark, "x")
    assert named is None or place.startswith(named.rstrip("/") + "/")
    assert place != session.run_folder(spark, "x")


def test_routing(spark):
    df = spark.createDataFrame([(f"u{i % 5}",) for i in range(50)], "user_id string")
    parts = readers.routed_by_user(df).select("user_id", F.spark_partition_id().alias("p")).distinct()
    assert parts.count() == 5


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.kafka_topics(spark, "localhost:1", ["events"])


def test_batches_by_bytes_do_not_follow_the_number_of_files(spark, folder):
    rows = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("value"), F.timestamp_seconds("id").alias("arrived_at"))
    batches = []
    for files in (8, 40):
        place = f"{folder}/{files}"
        rows.repartition(files).write.parquet(f"{place}/in")
        size = sum(f.stat().st_size for f in Path(f"{place}/in").glob("part-*"))
        seen = []
        stream = readers.message_files(spark, f"{place}/in", max_bytes=size // 3 + 1)
        stream.writeStream.foreachBatch(lambda df, n: seen.append(df.count())).option("checkpointLocation", f"{place}/state").trigger(
            availableNow=True
        ).start().awaitTermination()
        assert sum(seen) == 4000
        batches.append(len(seen))
    assert all(3 <= n <= 4 for n in batches)
    with pytest.raises(ValueError):
        readers.message_files(spark, folder, max_files=1, max_bytes=1)


def test_json_arrays_in_files_of_bounded_size(spark, folder):
    rows = spark.range(1000).select(F.concat(F.lit("p"), "id").alias("currency_pair"), (F.col("id") / 8).alias("rate"))
    sinks.json_arrays(rows, f"{folder}/arrays", "currency_pair", rows_per_file=100)
    files = list(Path(f"{folder}/arrays").glob("file=*/part-*"))
    arrays = [json.loads(f.read_text()) for f in files]
    assert len(files) == 10 and sum(map(len, arrays)) == 1000 and max(map(len, arrays)) < 200
    got = readers.exchange_rates(spark, f"{folder}/arrays", "2024-01-01 00:00:00")
    assert {(r.currency_pair, r.exchange_rate) for r in got.collect()} == {(f"p{i}", i / 8) for i in range(1000)}
    assert got.columns == ["currency_pair", "exchange_rate", "timestamp"]
    sinks.json_arrays(rows.where("rate < 0"), f"{folder}/no_arrays", "currency_pair")
    assert readers.exchange_rates(spark, f"{folder}/no_arrays", "2024-01-01 00:00:00").count() == 0
