"""Live signals: equal to the batch operators over ordered deliveries, defined for late, untimed and repeated rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martweave.plans import velocity as S
from martweave.streaming.signals import first_sights, instants_left, live_signals, write_signals
from martweave.streaming.windows import WindowStore

START = dt.datetime(2024, 1, 1)
SHAPE = "transaction_id string, company_id string, vendor_category string, arrived_at timestamp"


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def deliver(spark, folder, rows, **options):
    data = [(i, c, k, at(m)) for i, c, k, m in rows]
    spark.createDataFrame(data, SHAPE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SHAPE).parquet(f"{folder}/in")
    write_signals(stream, f"{folder}/out", f"{folder}/seen", f"{folder}/state", **options).awaitTermination()


def told(spark, folder):
    rows = spark.read.parquet(f"{folder}/out").collect()
    return {r.transaction_id: (r.recent_count, r.seconds_since_last, r.new_category, r.history_complete) for r in rows}


def random_rows(n, seed):
    draw = random.Random(seed)
    times = sorted(draw.choice([draw.uniform(0, 5000), draw.randrange(0, 5000, 50)]) for _ in range(n))
    # one company has most of the rows
    return [(f"t{i:04}", draw.choice("aaaab"), draw.choice("xyz"), m) for i, m in enumerate(times)]


def test_ordered_deliveries_equal_the_batch_operators(spark, folder):
    rows = random_rows(240, 7)
    # equal instants stay in one delivery
    cuts = [0, *[next(i for i in range(n, 240) if rows[i][3] != rows[i - 1][3]) for n in (50, 52, 170)], 240]
    for low, high in zip(cuts, cuts[1:], strict=False):
        deliver(spark, folder, rows[low:high], minutes=90)
    got = told(spark, folder)
    whole = spark.createDataFrame([(i, c, k, at(m)) for i, c, k, m in rows], SHAPE)
    busy = S.velocity(whole, "company_id", "arrived_at", limit=0, minutes=90).collect()
    assert {r.transaction_id: r.recent_count for r in busy} == {i: v[0] for i, v in got.items()}
    extended = S.extra_features(
        whole.withColumn("department", F.lit("d")).withColumn("amount_usd", F.lit(1)), "company_id", "arrived_at", "transaction_id"
    ).collect()
    assert {r.transaction_id: r.seconds_since_last for r in extended} == {i: v[1] for i, v in got.items()}
    order = [F.col("arrived_at"), F.col("transaction_id")]
    first = {r.transaction_id for r in S.first_in_category(whole, "company_id", "vendor_category", order).collect()}
    assert first == {i for i, v in got.items() if v[2]}
    assert all(v[3] for v in got.values())


def test_late_untimed_and_null_rows(spark, folder):
    deliver(spark, folder, [("1", "a", "x", 0), ("2", "a", "x", 10), ("3", None, None, 5), ("4", "b", "x", 300)], minutes=60)
    deliver(
        spark, folder,
        [("5", "a", "y", 20), ("6", "a", None, None), ("7", None, None, 6), ("8", "a", "x", 290), ("9", "a", "y", 301)],
        minutes=60,
    )
    got = told(spark, folder)
    assert got["1"] == (1, None, True, True) and got["2"] == (2, 600.0, False, True)
    # instants of a from before 240 are forgotten but for its newest
    assert got["5"] == (2, 600.0, True, False)
    assert got["6"] == (None, None, True, False)
    assert got["3"] == (1, None, True, True) and got["7"] == (2, 60.0, False, False)
    assert got["8"] == (1, 270 * 60.0, False, False) and got["9"] == (2, 660.0, False, True)


def test_a_batch_run_again_starts_from_the_same_state(spark, folder):
    rows = spark.createDataFrame([("1", "a", "x", at(0)), ("2", "a", "x", at(0)), ("3", "a", "y", at(1))], SHAPE)
    nothing = rows.limit(0).groupBy("company_id", "arrived_at").agg(F.count(F.lit(1)).alias("_n"))
    kept = instants_left(nothing, rows, "company_id", "arrived_at", F.lit(at(1)).cast("timestamp"))
    assert [(r.company_id, r.arrived_at, r._n) for r in kept.collect()] == [("a", at(1), 1)]
    store = WindowStore(f"{folder}/seen")
    store.keep(kept, at(1), 0)
    more = spark.createDataFrame([("4", "a", "y", at(2))], SHAPE)
    for _ in range(2):
        seen, mark = store.before(spark, 1, kept.schema)
        judged = live_signals(more, seen, "company_id", "arrived_at", "transaction_id", 60).first()
        assert (judged.recent_count, judged.seconds_since_last, mark) == (2, 60.0, at(1))
        store.keep(instants_left(seen, more, "company_id", "arrived_at", F.lit(at(2)).cast("timestamp")), at(2), 1)
    known = rows.select("company_id", "vendor_category").limit(0)
    assert first_sights(rows, known, "company_id", "vendor_category", "arrived_at", "transaction_id").count() == 2


def test_an_empty_stream_and_columns_of_like_names(spark, folder):
    shape = SHAPE + ", j string, recent string"
    spark.createDataFrame([], shape).coalesce(1).write.parquet(f"{folder}/in")
    spark.createDataFrame([("1", "a", "x", at(0), "s", "f")], shape).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    write_signals(stream, f"{folder}/out", f"{folder}/seen", f"{folder}/state").awaitTermination()
    row = spark.read.parquet(f"{folder}/out").first()
    assert (row.j, row.recent, row.recent_count, row.new_category) == ("s", "f", 1, True)
