"""Hotel booking marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import date_from_parts, days_before, days_between
from ..functions.ladders import at_least, member_of, text_flag
from ..functions.numbers import share_pct, sum_if
from ..operators.running import numbered_by_content

BOOKING_COLUMNS = [
    "hotel",
    "hotel_id",
    "hotel_name",
    "region",
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_month",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "meal",
    "market_segment",
    "distribution_channel",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "reserved_room_type",
    "assigned_room_type",
    "booking_changes",
    "deposit_type",
    "agent",
    "company",
    "days_in_waiting_list",
    "customer_type",
    "adr",
    "required_car_parking_spaces",
    "total_of_special_requests",
    "reservation_status",
    "reservation_status_date",
]

DIMENSIONS = [
    "hotel",
    "deposit_type",
    "market_segment",
    "distribution_channel",
    "customer_type",
    "reserved_room_type",
]


def stage_bookings(raw: DataFrame) -> DataFrame:
    return raw.select(*BOOKING_COLUMNS)


def transformed_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings of the two hotel kinds with a positive rate and stay, and their estimated revenue."""
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    shaped = bookings.filter(F.col("hotel").isin(*V.HOTEL_KINDS)).select(
        "hotel_id",
        "hotel",
        text_flag(F.col("is_canceled") == 1).alias("is_canceled"),
        F.col("lead_time").alias("leadtime_days"),
        date_from_parts("arrival_date_year", "arrival_date_month", "arrival_date_day_of_month").alias("arrival_date"),
        "arrival_date_week_number",
        "stays_in_weekend_nights",
        "stays_in_week_nights",
        nights.alias("total_stay_nights"),
        "adults",
        "children",
        "babies",
        text_flag((F.col("children") > 0) | (F.col("babies") > 0)).alias("is_family_booking"),
        F.col("meal").alias("meal_package"),
        "market_segment",
        "distribution_channel",
        text_flag(F.col("is_repeated_guest") == 1).alias("is_repeated_guest"),
        "previous_cancellations",
        "previous_bookings_not_canceled",
        "reserved_room_type",
        "assigned_room_type",
        "booking_changes",
        "deposit_type",
        "agent",
        "company",
        "days_in_waiting_list",
        "customer_type",
        F.col("adr").alias("average_daily_rate"),
        "required_car_parking_spaces",
        "total_of_special_requests",
        "reservation_status",
        F.col("reservation_status_date").alias("reservation_status_update_date"),
    )
    return shaped.filter((F.col("average_daily_rate") > 0) & (F.col("total_stay_nights") > 0)).withColumn(
        "estimated_revenue", F.col("average_daily_rate") * F.col("total_stay_nights")
    )


def cancellation_details(bookings: DataFrame) -> DataFrame:
    canceled = F.col("is_canceled") == "TRUE"
    arrival, updated = F.col("arrival_date"), F.col("reservation_status_update_date")
    booked = days_before(arrival, "leadtime_days")
    days_left = days_between(arrival, updated)
    outcome = F.when(canceled, F.lit("Canceled")).otherwise(F.lit("Retained"))
    return bookings.select(
        "hotel_id",
        "hotel",
        "is_canceled",
        "leadtime_days",
        "arrival_date",
        "reservation_status",
        "reservation_status_update_date",
        "deposit_type",
        "average_daily_rate",
        "total_stay_nights",
        "estimated_revenue",
        "market_segment",
        "distribution_channel",
        "customer_type",
        "reserved_room_type",
        "assigned_room_type",
        "previous_cancellations",
        booked.alias("booking_date"),
        F.when(canceled, days_between(updated, booked)).alias("days_to_cancellation"),
        F.when(canceled, days_left).alias("days_before_arrival_at_cancellation"),
        F.coalesce(canceled & (days_left < V.LATE_CANCELLATION_DAYS), F.lit(False)).alias("is_late_cancellation"),
        F.concat(outcome, F.lit(" - "), F.coalesce("deposit_type", F.lit(V.NO_DEPOSIT))).alias(
            "deposit_cancellation_outcome"
        ),
        F.when(canceled, F.col("estimated_revenue")).otherwise(F.lit(0)).alias("revenue_lost"),
    )


def _lead_band(low, high):
    days = F.col("leadtime_days")
    if low is None:
        return days <= high
    if high is None:
        return days >= low
    return days.between(low, high)


def cancellation_analysis(details: DataFrame) -> DataFrame:
    """Cancellation KPIs per dimension group, lead-time profile of its canceled bookings, and
    one row per deposit outcome of the group.

    The three measures have nested grains, so one pass builds the finest (at most two
    outcomes per group, combined before the shuffle) and the coarser two are sums over it.
    A group with a missing dimension has no lead-time or deposit part: such keys match
    nothing in a join.
    """
    known = F.lit(True)
    for name in DIMENSIONS:
        known = known & F.col(name).isNotNull()
    canceled = F.col("is_canceled") == "TRUE"
    retained = F.col("is_canceled") == "FALSE"
    late = F.col("is_late_cancellation")
    days, rate = F.col("leadtime_days"), F.col("average_daily_rate")
    in_profile = canceled & known

    finest = (
        details.withColumn("_outcome", F.when(known, F.col("deposit_cancellation_outcome")))
        .groupBy(*DIMENSIONS, "_outcome")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(canceled).alias("_canceled"),
            F.sum("revenue_lost").alias("_lost"),
            F.sum(F.when(canceled, rate)).alias("_rate_c"),
            F.count(F.when(canceled, rate)).alias("_rate_cn"),
            F.sum(F.when(retained, rate)).alias("_rate_r"),
            F.count(F.when(retained, rate)).alias("_rate_rn"),
            F.count_if(late).alias("_late"),
            sum_if(late, "revenue_lost").alias("_late_lost"),
            F.sum(F.when(in_profile, days)).alias("_days"),
            F.count(F.when(in_profile, days)).alias("_days_n"),
            F.min(F.when(in_profile, days)).alias("_days_min"),
            F.max(F.when(in_profile, days)).alias("_days_max"),
            # null, not 0, for a group without canceled bookings
            *[
                F.sum(F.when(in_profile, F.when(_lead_band(low, high), 1).otherwise(0))).alias(name)
                for name, low, high in V.LEAD_BANDS
            ],
        )
    )
    group = Window.partitionBy(*DIMENSIONS)

    def total(name: str):
        return F.sum(name).over(group)

    def mean(top: str, bottom: str, digits: int):
        return F.round(F.try_divide(total(top), total(bottom)), digits)

    return finest.select(
        *DIMENSIONS,
        total("_n").alias("total_bookings"),
        total("_canceled").alias("total_cancellations"),
        share_pct(total("_canceled"), total("_n")).alias("cancellation_rate_pct"),
        F.round(total("_lost"), 2).alias("total_revenue_lost"),
        mean("_rate_c", "_rate_cn", 2).alias("avg_adr_canceled"),
        mean("_rate_r", "_rate_rn", 2).alias("avg_adr_retained"),
        total("_late").alias("late_cancellation_count"),
        F.round(total("_late_lost"), 2).alias("late_cancellation_revenue_lost"),
        mean("_days", "_days_n", 1).alias("avg_leadtime_canceled"),
        F.min("_days_min").over(group).alias("min_leadtime_canceled"),
        F.max("_days_max").over(group).alias("max_leadtime_canceled"),
        *[total(name).alias(name) for name, _, _ in V.LEAD_BANDS],
        F.col("_outcome").alias("deposit_cancellation_outcome"),
        F.when(F.col("_outcome").isNotNull(), share_pct("_canceled", "_n")).alias(
            "deposit_type_cancellation_rate_pct"
        ),
    ).orderBy(F.desc("total_revenue_lost"))


def lead_time_profile(details: DataFrame) -> DataFrame:
    """Lead-time statistics per dimension group, canceled and kept bookings apart."""
    return details.groupBy(*DIMENSIONS, "is_canceled").agg(
        F.round(F.avg("leadtime_days"), 1).alias("avg_leadtime_days"),
        F.min("leadtime_days").alias("min_leadtime_days"),
        F.max("leadtime_days").alias("max_leadtime_days"),
        *[F.count_if(_lead_band(low, high)).alias(name) for name, low, high in V.LEAD_BANDS],
    )


def deposit_effectiveness(details: DataFrame) -> DataFrame:
    return details.groupBy(*DIMENSIONS, "deposit_cancellation_outcome").agg(
        F.count(F.lit(1)).alias("booking_count"),
        F.round(F.sum("revenue_lost"), 2).alias("revenue_lost"),
        share_pct(F.count_if(F.col("is_canceled") == "TRUE"), F.count(F.lit(1))).alias("cancellation_rate_pct"),
    )


def daily_revenue(bookings: DataFrame, staged: DataFrame) -> DataFrame:
    """Revenue per hotel and arrival day.

    Grouped by hotel kind too though it is not shown, and joined to all names a hotel id
    goes by, so a day can appear more than once.
    """
    names = staged.select("hotel_id", "hotel_name").distinct()
    revenue = (
        bookings.groupBy("hotel_id", "hotel", "arrival_date")
        .agg(F.round(F.sum("estimated_revenue"), 2).alias("total_revenue"))
        .drop("hotel")
    )
    return (
        revenue.join(names, "hotel_id", "inner")
        .select("arrival_date", "hotel_id", "hotel_name", "total_revenue")
        .orderBy(F.desc("arrival_date"), "hotel_id")
    )


SEGMENT_INPUT = [
    "leadtime_days",
    "total_stay_nights",
    "is_repeated_guest",
    "previous_cancellations",
    "reserved_room_type",
    "average_daily_rate",
    "reservation_status",
    "estimated_revenue",
]


def customer_segments(bookings: DataFrame, numbering: str = "unordered", order: Sequence[str] = SEGMENT_INPUT) -> DataFrame:
    """Segment, loyalty score and tier per booking.

    `customer_id` only has to be unique.  "unordered" numbers rows as they come, without a
    shuffle; "content" gives consecutive numbers in content order, the same on every run.
    """
    rows = bookings.select(*SEGMENT_INPUT)
    if numbering == "content":
        rows = numbered_by_content(rows, order, "customer_id", "segments")
    else:
        rows = rows.select((F.monotonically_increasing_id() + 1).alias("customer_id"), *SEGMENT_INPUT)
    days, nights, repeat = F.col("leadtime_days"), F.col("total_stay_nights"), F.col("is_repeated_guest")
    segment = (
        F.when((days < 30) & (nights < 3) & (repeat == "FALSE"), "New")
        .when((days >= 30) & (nights >= 3) & (repeat == "TRUE"), "Loyal")
        .otherwise("Occasional")
    )
    score = (
        at_least(nights, V.STAY_POINTS, 0)
        + F.when(repeat == "TRUE", V.REPEAT_GUEST_POINTS).otherwise(0)
        + F.when(F.col("previous_cancellations") > 0, V.CANCELLATION_PENALTY).otherwise(0)
        + member_of("reserved_room_type", V.ROOM_POINTS, 0)
        + at_least("average_daily_rate", V.RATE_POINTS, 0)
        + member_of("reservation_status", V.RESERVATION_POINTS, 0)
        + at_least("estimated_revenue", V.REVENUE_POINTS, 0)
    )
    open_tier = at_least("total_loyalty_score", V.OPEN_TIERS, V.TIER_DEFAULT)
    tier = at_least("total_loyalty_score", V.LOYAL_TIERS, open_tier, extra=F.col("customer_segment") == "Loyal")
    return (
        rows.withColumn("customer_segment", segment)
        .withColumn("total_loyalty_score", score)
        .withColumn("loyalty_tier", tier)
        .select(
            "customer_id",
            "customer_segment",
            "leadtime_days",
            "total_stay_nights",
            "previous_cancellations",
            "reserved_room_type",
            "average_daily_rate",
            "estimated_revenue",
            "total_loyalty_score",
            "loyalty_tier",
        )
    )


def customer_segmentation(segments: DataFrame) -> DataFrame:
    """Profile per segment and tier, with its share of the tier and of the segment."""
    grouped = segments.groupBy("customer_segment", "loyalty_tier").agg(
        F.count("customer_id").alias("customer_count"),
        F.round(F.avg("leadtime_days"), 1).alias("avg_leadtime_days"),
        F.round(F.avg("total_stay_nights"), 1).alias("avg_stay_nights"),
        F.sum("total_stay_nights").alias("total_stay_nights"),
        share_pct(F.count_if(F.col("previous_cancellations") > 0), F.count("customer_id")).alias(
            "cancellation_rate_pct"
        ),
        F.round(F.avg("average_daily_rate"), 2).alias("avg_daily_rate"),
        F.round(F.sum("average_daily_rate"), 2).alias("total_revenue_proxy"),
        F.round(F.avg("total_loyalty_score"), 1).alias("avg_loyalty_score"),
        F.min("total_loyalty_score").alias("min_loyalty_score"),
        F.max("total_loyalty_score").alias("max_loyalty_score"),
    )
    count = F.col("customer_count")
    in_tier = F.sum(count).over(Window.partitionBy("loyalty_tier"))
    in_segment = F.sum(count).over(Window.partitionBy("customer_segment"))
    return (
        grouped.withColumn("pct_of_tier", share_pct(count, in_tier))
        .withColumn("pct_of_segment", share_pct(count, in_segment))
        .orderBy("loyalty_tier", "customer_segment")
    )
