"""Sliding windows from panes against the engine's own."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martweave.operators.panes import micros, sliding_totals

START = dt.datetime(1969, 12, 31, 22)


def rows(spark, n=300, seed=3):
    draw = random.Random(seed)
    data = [
        (draw.choice(["a", "a", "a", "b", None]), draw.choice([None, draw.randrange(-50, 50)]), START + dt.timedelta(seconds=draw.choice([draw.randrange(9000), 30, 6 * 3600])))
        for _ in range(n)
    ]
    return spark.createDataFrame([*data, ("a", 1, None), ("c", 2, None)], "k string, v long, t timestamp")


TOTALS = {"n": ("sum", F.count), "total": ("sum", F.sum), "low": ("min", F.min), "high": ("max", F.max)}


def as_set(df):
    return sorted(((r.window.start, r.window.end, r.k, r.n, r.total, r.low, r.high) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "size, slide", [("10 minutes", "5 minutes"), ("24 hours", "5 minutes"), ("10 minutes", "4 minutes"), ("7 minutes", "7 minutes"), ("3 seconds", "2 seconds")]
)
def test_panes_equal_the_windows_of_the_engine(spark, size, slide):
    df = rows(spark)
    totals = {name: (kind, function("v")) for name, (kind, function) in TOTALS.items()}
    expected = df.groupBy(F.window("t", size, slide).alias("window"), "k").agg(*[e.alias(n) for n, (_, e) in totals.items()])
    assert as_set(sliding_totals(df, "t", size, slide, ["k"], totals)) == as_set(expected)


def test_one_scan_and_no_copies_of_rows(spark, folder):
    rows(spark).write.parquet(folder + "/in")
    df = spark.read.parquet(folder + "/in")
    plan = sliding_totals(df, "t", "24 hours", "5 minutes", ["k"], {"n": ("sum", F.count("v"))})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" not in plan
    # what is exploded stands above the aggregate over the rows
    assert plan.index("Generate") < plan.index("Aggregate") and "Generate" not in plan[plan.index("Aggregate") :]


def test_empty_rows_and_lengths(spark):
    assert sliding_totals(rows(spark).limit(0), "t", "2 hours", "1 hour", ["k"], {"n": ("sum", F.count("v"))}).count() == 0
    assert micros("1 day 6 hours") == 30 * 3600 * 10**6 and micros("90 seconds") == 90 * 10**6
    for bad in ("1 month", "", "x"):
        with pytest.raises(ValueError):
            micros(bad)
    with pytest.raises(ValueError):
        sliding_totals(rows(spark), "t", "1 minute", "2 minutes", ["k"], {})
