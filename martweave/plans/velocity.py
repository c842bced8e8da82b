"""Further spend signals: velocity, new categories, repeats, outliers, spend per period, extra features.

Described for the data model without a given implementation; thresholds are parameters.
Windows over one company's history are cut at fixed time blocks, so a company with a third
of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..session import pin

MICROS = 1_000_000
# time blocks are at least so many spans long
_SPANS = 8


def _micros(stamp: str) -> Column:
    return F.unix_micros(stamp)


def with_lead_in(df: DataFrame, stamp: str, span: int, block: int) -> DataFrame:
    """Rows in their own time block and, where within `span` of its end, once more in the next
    block as lead-in.  `span` must not exceed `block` (both in microseconds)."""
    at = _micros(stamp)
    own = F.floor(at / F.lit(block)).cast("bigint")
    into_next = F.floor((at + F.lit(span)) / F.lit(block)).cast("bigint")
    copies = F.when(into_next > own, F.array(own, into_next)).otherwise(F.array(own))
    return (
        df.withColumn("_at", at)
        .withColumn("_own", own)
        .withColumn("_block", F.explode(copies))
    )


def time_blocks(span: int, hours: int) -> int:
    """Several spans long, so that only the rows near a block's end are copied."""
    return max(hours * 3600 * MICROS, _SPANS * span)


def velocity(
    transactions: DataFrame, company: str, stamp: str, limit: int, minutes: int, block_hours: int = 1
) -> DataFrame:
    """Transactions that make more than `limit` within the last `minutes` for their company.

    The count includes the row itself and everything up to and at its instant.
    """
    span = minutes * 60 * MICROS
    block = time_blocks(span, block_hours)
    rows = with_lead_in(transactions, stamp, span, block)
    recent = Window.partitionBy(company, "_block").orderBy("_at").rangeBetween(-span, 0)
    return (
        rows.withColumn("recent_count", F.count(F.lit(1)).over(recent))
        .filter((F.col("_block") == F.col("_own")) & (F.col("recent_count") > limit))
        .drop("_at", "_own", "_block")
    )


def first_in_category(transactions: DataFrame, company: str, category: str, order: Sequence[Column]) -> DataFrame:
    """First transaction of each company in each vendor category."""
    first = Window.partitionBy(company, category).orderBy(*order)
    return transactions.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") == 1).drop("_r")


def repeated_payments(
    transactions: DataFrame, keys: Sequence[str], stamp: str, minutes: int, block_hours: int = 1
) -> DataFrame:
    """Transactions with an earlier one of the same `keys` (company, vendor, amount) within `minutes`."""
    span = minutes * 60 * MICROS
    block = time_blocks(span, block_hours)
    rows = with_lead_in(transactions, stamp, span, block)
    earlier = Window.partitionBy(*keys, "_block").orderBy("_at").rangeBetween(-span, -1)
    return (
        rows.withColumn("_last", F.max("_at").over(earlier))
        .filter((F.col("_block") == F.col("_own")) & F.col("_last").isNotNull())
        .withColumn("seconds_since", (F.col("_at") - F.col("_last")) / F.lit(MICROS))
        .drop("_at", "_own", "_block", "_last")
    )


def daily_outliers(daily: DataFrame, company: str, day: str, amount: str, deviations: float, rows: int = 30) -> DataFrame:
    """Company days whose total lies more than `deviations` standard deviations above the mean
    of the preceding `rows` days with spend; at least two of them are needed."""
    before = Window.partitionBy(company).orderBy(day).rowsBetween(-rows, -1)
    value = F.col(amount).cast("double")
    mean, spread = F.avg(value).over(before), F.stddev_samp(value).over(before)
    return (
        daily.withColumn("mean_before", mean)
        .withColumn("spread_before", spread)
        .filter(value > F.col("mean_before") + F.lit(float(deviations)) * F.col("spread_before"))
    )


def spend_by(transactions: DataFrame, keys: Sequence[Column | str], amount: str = "amount_usd") -> DataFrame:
    """Transactions and spend per key: a period, a department, a vendor category or any mix."""
    return transactions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum(amount).alias("total_amount_usd")
    )


def extra_features(transactions: DataFrame, company: str, stamp: str, tie: str) -> DataFrame:
    """Seconds since the company's previous transaction, share of its transactions in the same
    category, and share of the amount in its department's spend.

    Previous times come from blocks of an hour plus the newest time of the last earlier hour
    with rows.  All totals come from one table of hourly totals per category and department,
    written once, so the transactions are read twice and no window spans a company.
    """
    rows = transactions.withColumn("_at", _micros(stamp)).withColumn("_hour", F.date_trunc("hour", stamp))
    totals = pin(
        rows.groupBy(company, "_hour", "vendor_category", "department").agg(
            F.max("_at").alias("_newest"), F.count(F.lit(1)).alias("_n"), F.sum("amount_usd").alias("_amount")
        ),
        "hourly",
    )
    earlier = Window.partitionBy(company).orderBy("_hour")
    hours = totals.groupBy(company, "_hour").agg(F.max("_newest").alias("_newest"))
    hours = hours.select(company, "_hour", F.lag("_newest").over(earlier).alias("_before_hour"))
    inside = Window.partitionBy(company, "_hour").orderBy("_at", tie)
    rows = rows.join(hours, [company, "_hour"], "inner").withColumn(
        "_previous", F.coalesce(F.lag("_at").over(inside), F.col("_before_hour"))
    )
    by_category = totals.groupBy(company, "vendor_category").agg(F.sum("_n").alias("_n_category"))
    by_company = by_category.groupBy(company).agg(F.sum("_n_category").alias("_n_company"))
    by_department = totals.groupBy(company, "department").agg(F.sum("_amount").alias("_department_total"))
    return (
        rows.join(by_category, [company, "vendor_category"], "left")
        .join(by_company, company, "left")
        .join(by_department, [company, "department"], "left")
        .select(
            *transactions.columns,
            ((F.col("_at") - F.col("_previous")) / F.lit(MICROS)).alias("seconds_since_last"),
            F.round(ratio("_n_category", "_n_company"), 6).alias("category_frequency"),
            F.round(ratio(F.col("amount_usd").cast("double"), F.col("_department_total").cast("double")), 6).alias(
                "department_spend_ratio"
            ),
        )
    )


def reconcile(left: DataFrame, right: DataFrame, key: str, measure: str) -> DataFrame:
    """Keys on which two tables disagree about a measure, or that only one of them has."""
    a = left.select(key, F.col(measure).alias("left_value"))
    b = right.select(key, F.col(measure).alias("right_value"))
    return a.join(b, key, "full_outer").filter(~F.col("left_value").eqNullSafe(F.col("right_value")))


def freshness(df: DataFrame, name: str, stamp: str, as_of, max_age_hours: int) -> DataFrame:
    """One row: newest time of a table, its age at `as_of`, and whether it is fresh enough."""
    newest = df.agg(F.max(stamp).cast("timestamp").alias("newest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest")) / F.lit(3600 * MICROS)
    return newest.select(
        F.lit(name).alias("table"),
        "newest",
        F.round(age, 4).alias("age_hours"),
        F.coalesce(age <= max_age_hours, F.lit(False)).alias("fresh"),
    )


def enrolment_status(applications: DataFrame, statements: DataFrame, limit: float = 0.0) -> DataFrame:
    """Applications of students whose balance is at most `limit` are enrolled; with a higher
    balance they wait, without a statement they stay applied."""
    balance = F.col("_balance")
    status = F.when(balance.isNull(), "applied").when(balance <= limit, "enrolled").otherwise("processing")
    due = statements.select("student_id", F.col("balance").alias("_balance"))
    return applications.join(due, "student_id", "left").select(*applications.columns, status.alias("status"))
