"""A mart kept up to date by runs equals one built at once."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from martweave.operators.distinct import distinct_partials, from_partials
from martweave.operators.marts import DailyMart, _of_days

GROUP, COUNTED = ["on_day", "k"], {"vendors": "v", "kinds": "c"}


def partials(rows):
    return distinct_partials(rows, GROUP, COUNTED, {"_n": F.count(F.lit(1)), "_sum": F.sum("x"), "_top": F.max("x")})


def finish(parts):
    return from_partials(parts, GROUP, COUNTED, {"n": F.sum("_n"), "total": F.sum("_sum"), "top": F.max("_top")})


def source(spark):
    # most rows belong to one key and day; some have no day, no key, no vendor
    day = F.when(F.col("id") % 50 == 7, None).otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 10 - 5).cast("int")))
    return spark.range(1000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2024, 1, 2))).otherwise(day).alias("on_day"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 4 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("k"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 17).alias("v"),
        (F.col("id") % 6).alias("c"),
        (F.col("id") * 7 % 101).alias("x"),
    )


def as_set(df):
    return sorted((tuple(r) for r in df.select(*GROUP, *COUNTED, "n", "total", "top").collect()), key=str)


def test_counts_equal_plain_aggregates(spark):
    rows = source(spark)
    plain = rows.groupBy(*GROUP).agg(
        F.countDistinct("v").alias("vendors"), F.countDistinct("c").alias("kinds"),
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.max("x").alias("top"),
    )
    assert as_set(finish(partials(rows))) == as_set(plain)
    lots = [partials(rows.filter(F.col("id") % 3 == n)) for n in range(3)]
    assert as_set(finish(lots[0].unionByName(lots[1]).unionByName(lots[2]))) == as_set(plain)


def test_runs_equal_one_build_and_leave_other_days_alone(spark, folder):
    rows = source(spark)
    mart = DailyMart(f"{folder}/mart", "on_day", partials, finish)
    assert mart.rows(spark) is None
    mart.update(rows.filter("id < 500"), 0)
    before = {p: p.stat().st_mtime_ns for p in _files(folder)}
    second = rows.filter("id >= 500 and (id % 10 = 0 or id % 50 = 7)")
    days = mart.update(second, 1)
    assert None in days and len(days) == 3
    kept = [p for p in before if p in set(_files(folder))]
    assert {str(p).split("_day=")[1].split("/")[0] for p in before if p not in kept} == {str(d) if d else "__HIVE_DEFAULT_PARTITION__" for d in days}
    assert as_set(mart.rows(spark)) == as_set(finish(partials(rows.filter("id < 500").unionByName(second))))
    # a run that is run again, and one without rows
    assert mart.update(second, 1) == days and mart.update(rows.limit(0), 2) == []
    mart.update(rows.filter("id >= 500 and not (id % 10 = 0 or id % 50 = 7)"), 3)
    assert as_set(mart.rows(spark)) == as_set(finish(partials(rows)))


def test_only_folders_of_the_days_are_read(spark, folder):
    mart = DailyMart(f"{folder}/mart", "on_day", partials, finish)
    mart.update(source(spark), 0)
    stored = spark.read.parquet(f"{folder}/mart/partials")
    picked = _of_days(stored, [dt.date(2024, 1, 2)])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan or "PartitionFilters: [_day" in plan
    n = picked.count()
    for part in Path(f"{folder}/mart/partials").rglob("part-*"):
        if "_day=2024-01-02" not in str(part):
            part.write_text("not read")
    assert picked.agg(F.sum("_n")).first()[0] == source(spark).filter("on_day = date '2024-01-02'").count() and n > 0


def _files(folder):
    return list(Path(f"{folder}/mart/rows").rglob("part-*"))
