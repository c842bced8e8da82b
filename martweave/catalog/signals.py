"""Registered queries of the further spend signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import spend as P
from ..plans import velocity as S
from . import spend
from .common import Catalog, dbl, moment, plain, rounded
from .standins import TRANSACTIONS

catalog = Catalog()


def rows(spark, folder):
    return spend.transactions(spark, folder).withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,2)"))


_ROWS_SQL = f"(select * replace (cast(amount_usd as decimal(18,2)) as amount_usd) from {TRANSACTIONS.sql})"


@catalog.add(
    "velocity_alerts",
    f"""select transaction_id, company_id, n recent_count from (select *, count(*) over (partition by company_id order by ts
    range between interval 360 minute preceding and current row) n from {_ROWS_SQL}) where n > 2""",
)
def _(spark, folder):
    busy = S.velocity(rows(spark, folder), "company_id", "ts", limit=2, minutes=360)
    return plain(busy.select("transaction_id", "company_id", "recent_count"))


@catalog.add(
    "new_vendor_category",
    f"""select transaction_id, company_id, vendor_category from (select *, row_number() over
    (partition by company_id, vendor_category order by ts, event_id) r from {_ROWS_SQL}) where r = 1""",
)
def _(spark, folder):
    first = S.first_in_category(rows(spark, folder), "company_id", "vendor_category", [F.col("ts"), F.col("event_id")])
    return plain(first.select("transaction_id", "company_id", "vendor_category"))


@catalog.add(
    "duplicate_like",
    f"""select transaction_id, company_id, vendor_id, {rounded("date_diff('microsecond', before, ts) / 1000000.0", 6)} seconds_since
    from (select *, lag(ts) over (partition by company_id, vendor_id, floor(amount_usd / 500) order by ts) before from {_ROWS_SQL})
    where before >= ts - interval 2880 minute""",
)
def _(spark, folder):
    """Same company, vendor and amount within two days; amounts in steps of 500, so that they repeat."""
    stepped = rows(spark, folder).withColumn("amount_usd", F.floor(F.col("amount_usd") / 500))
    repeated = S.repeated_payments(stepped, ["company_id", "vendor_id", "amount_usd"], "ts", minutes=2880)
    return plain(repeated.select("transaction_id", "company_id", "vendor_id", "seconds_since"), {"seconds_since": 6})


@catalog.add(
    "amount_outliers",
    f"""select company_id, on_day::varchar transaction_date, {dbl('total')} total_amount_usd, {rounded('mean', 6)} mean_before, {rounded('spread', 6)} spread_before
    from (select *, avg(total::double) over w mean, stddev_samp(total::double) over w spread
      from (select company_id, cast(ts as date) on_day, sum(amount_usd) total from {_ROWS_SQL} group by all)
      window w as (partition by company_id order by on_day rows between 30 preceding and 1 preceding))
    where total::double > mean + 2.5 * spread""",
)
def _(spark, folder):
    daily = rows(spark, folder).groupBy("company_id", F.to_date("ts").alias("transaction_date")).agg(
        F.sum("amount_usd").alias("total_amount_usd")
    )
    outliers = S.daily_outliers(daily, "company_id", "transaction_date", "total_amount_usd", 2.5)
    return plain(outliers, {"mean_before": 6, "spread_before": 6})


def _by_sql(keys: str) -> str:
    return f"select {keys}, count(*) transaction_count, {dbl('sum(amount_usd)')} total_amount_usd from {_ROWS_SQL} group by all"


@catalog.add("spend_by_week", _by_sql(f"""{moment("date_trunc('week', ts)")} period, department"""))
def _(spark, folder):
    period = F.date_trunc("week", "ts").alias("period")
    return plain(S.spend_by(rows(spark, folder), [period, "department"]))


@catalog.add("spend_by_month", _by_sql(f"""{moment("date_trunc('month', ts)")} period, vendor_category"""))
def _(spark, folder):
    period = F.date_trunc("month", "ts").alias("period")
    return plain(S.spend_by(rows(spark, folder), [period, "vendor_category"]))


@catalog.add(
    "spend_windows_hourly",
    f"""select company_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S+00:00') window_start, count(*) transaction_count,
    {dbl('sum(amount_usd)')} total_amount_usd from {_ROWS_SQL} group by all""",
)
def _(spark, folder):
    windows = P.spend_windows(spend.scored(spark, folder), "ts", "1 hour")
    return plain(windows.select("company_id", "window_start", "transaction_count", "total_amount_usd"))


@catalog.add(
    "sliding_windows",
    f"""select company_id, strftime(w, '%Y-%m-%dT%H:%M:%S+00:00') window_start, count(*) transaction_count, {dbl('sum(amount_usd)')} total_amount_usd
    from (select *, unnest([time_bucket(interval 5 minute, ts), time_bucket(interval 5 minute, ts) - interval 5 minute]) w from {_ROWS_SQL})
    group by all""",
)
def _(spark, folder):
    windows = P.spend_windows(spend.scored(spark, folder), "ts", "10 minutes", "5 minutes")
    return plain(windows.select("company_id", "window_start", "transaction_count", "total_amount_usd"))


@catalog.add(
    "rolling_day_peaks",
    f"""select company_id, max(n) most_transactions, {dbl('max(total)')} most_spent_usd, count(*) windows, sum(n)::bigint counted
    from (select company_id, w, count(*) n, sum(amount_usd) total
      from (select *, unnest(range(288)) back from {_ROWS_SQL}), lateral (select time_bucket(interval 5 minute, ts) - back * interval 5 minute w)
      group by all) group by company_id""",
)
def _(spark, folder):
    """Busiest and dearest 24 hours of each company, among those that start at any five minutes."""
    windows = P.spend_windows(spend.scored(spark, folder), "ts", "24 hours", "5 minutes")
    return plain(
        windows.groupBy("company_id").agg(
            F.max("transaction_count").alias("most_transactions"),
            F.max("total_amount_usd").alias("most_spent_usd"),
            F.count(F.lit(1)).alias("windows"),
            F.sum("transaction_count").alias("counted"),
        )
    )


@catalog.add(
    "extra_features",
    f"""select transaction_id, {rounded("date_diff('microsecond', lag(ts) over (partition by company_id order by ts, transaction_id), ts) / 1000000.0", 6)} seconds_since_last,
    {rounded("count(*) over (partition by company_id, vendor_category) / count(*) over (partition by company_id)", 6)} category_frequency,
    {rounded("amount_usd::double / nullif(sum(amount_usd) over (partition by company_id, department), 0)::double", 6)} department_spend_ratio
    from {_ROWS_SQL}""",
)
def _(spark, folder):
    extended = S.extra_features(rows(spark, folder), "company_id", "ts", "transaction_id")
    columns = ["transaction_id", "seconds_since_last", "category_frequency", "department_spend_ratio"]
    return plain(extended.select(*columns), {"seconds_since_last": 6})
