"""Shop behaviour reports: revenue over time, funnel, abandonment, best sellers, RFM, geography, devices.

These metrics are described for the data model but come without a given implementation;
thresholds that are not defined anywhere are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import line_total
from ..functions.numbers import ratio
from ..operators.ranking import top_per_group


def revenue_by(orders: DataFrame, stamp: str, amount: str, grain: str) -> DataFrame:
    """Orders and revenue per hour, day, week or month."""
    return orders.groupBy(F.date_trunc(grain, F.col(stamp)).alias("period")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(amount).alias("revenue")
    )


def _per_session(events: DataFrame, session: Sequence[str]) -> DataFrame:
    kind = F.col("type")
    return events.groupBy(*session).agg(
        F.bool_or(kind == "page_view").alias("viewed"),
        F.bool_or(kind == "add_to_cart").alias("carted"),
        F.bool_or(kind == "checkout_started").alias("checked_out"),
        F.bool_or(kind == "purchase").alias("bought"),
    )


def funnel(events: DataFrame, session: Sequence[str] = ("session_id",)) -> DataFrame:
    """Sessions reaching each step, and the share of viewing sessions that went on to it."""
    steps = _per_session(events, session).agg(
        F.count_if("viewed").alias("view_sessions"),
        F.count_if(F.col("viewed") & F.col("carted")).alias("cart_sessions"),
        F.count_if(F.col("viewed") & F.col("carted") & F.col("bought")).alias("purchase_sessions"),
    )
    return steps.select(
        "view_sessions",
        "cart_sessions",
        "purchase_sessions",
        F.round(ratio("cart_sessions", "view_sessions"), 4).alias("cart_rate"),
        F.round(ratio("purchase_sessions", "view_sessions"), 4).alias("purchase_rate"),
    )


def cart_abandonment(events: DataFrame, session: Sequence[str] = ("session_id",)) -> DataFrame:
    """Share of sessions with a cart and no purchase."""
    carts = _per_session(events, session).filter("carted")
    counts = carts.agg(
        F.count(F.lit(1)).alias("cart_sessions"), F.count_if(~F.col("bought")).alias("abandoned_sessions")
    )
    return counts.withColumn(
        "abandonment_rate", F.round(ratio("abandoned_sessions", "cart_sessions"), 4)
    )


def top_products(lines: DataFrame, product: str, measure: Column, n: int = 10, name: str = "total") -> DataFrame:
    """The `n` products with the largest total; a top-k report, so no full sort."""
    return lines.groupBy(product).agg(measure.alias(name)).orderBy(F.desc(name), F.asc(product)).limit(n)


def rfm(orders: DataFrame, user: str, stamp: str, amount: str, as_of) -> DataFrame:
    """Days since the last order, number of orders and total spend per user."""
    return orders.groupBy(user).agg(
        F.datediff(F.lit(as_of).cast("date"), F.max(F.to_date(stamp))).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(amount).alias("monetary_total"),
    )


def rfm_segments(scores: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Adds the list of segments whose rule a user meets; the rules are the caller's."""
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in rules]))
    return scores.withColumn("segments", names)


def recent_orders(orders: DataFrame, user: str, order: Sequence[Column], fields: Sequence[str], n: int = 10) -> DataFrame:
    """The last `n` orders of each user as one list, newest first."""
    last = top_per_group(orders, [user], order, n, "_rank")
    entries = F.array_sort(F.collect_list(F.struct("_rank", *fields)))
    return last.groupBy(user).agg(
        F.transform(entries, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("recent_orders")
    )


def orders_by_geography(orders: DataFrame, place: Sequence[str], amount: str) -> DataFrame:
    return orders.groupBy(*place).agg(F.count(F.lit(1)).alias("orders"), F.sum(amount).alias("revenue"))


def device_conversion(events: DataFrame, device: str = "device_type") -> DataFrame:
    """Views, purchases and purchases per view for each device type."""
    counts = events.groupBy(device).agg(
        F.count_if(F.col("type") == "page_view").alias("views"),
        F.count_if(F.col("type") == "purchase").alias("purchases"),
    )
    return counts.withColumn("conversion_rate", F.round(ratio("purchases", "views"), 4))


def order_total_gaps(orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose subtotal differs from the sum of their line items by more than `tolerance`."""
    lines = line_total("items")
    gap = F.abs(lines - F.col("totals.subtotal").cast("decimal(18,2)"))
    return orders.filter(gap > F.lit(tolerance).cast("decimal(18,6)")).select("order_id", lines.alias("line_total"), gap.alias("gap"))
