"""Customer spend and daily sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.numbers import currency_text, sum_if
from ..sources.sinks import append_newer, newer_rows


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", "first_name", "last_name", "email")


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("amount").cast("decimal(10,2)").alias("order_amount"),
        "order_status",
    )


def newer_orders(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    """Staged orders dated after the last date already stored."""
    return newer_rows(stage_orders(raw), target, "order_date")


def load_orders(raw: DataFrame, path: str) -> DataFrame:
    """Incremental load of the staged orders at `path`."""
    return append_newer(stage_orders(raw), path, "order_date")


def customer_spend(customers: DataFrame, orders: DataFrame, scale: int = 0) -> DataFrame:
    """Order count and formatted spend per customer, nulls without orders."""
    spend = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("order_amount").alias("total_spend")
    )
    return customers.join(spend, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "total_orders",
        currency_text("total_spend", "$", scale).alias("total_spend_formatted"),
    )


def daily_sales(orders: DataFrame) -> DataFrame:
    """Order counts and sales per day and status, newest day first."""
    status = F.col("order_status")
    by_day = orders.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("total_orders"),
        *[F.count_if(status == s).alias(f"total_{s}_orders") for s in V.DAILY_STATUSES],
        sum_if(status == "completed", "order_amount").alias("total_completed_sales"),
        sum_if(status == "returned", "order_amount").alias("total_returned_sales"),
    )
    net = F.col("total_completed_sales") - F.col("total_returned_sales")
    return by_day.withColumn("total_net_sales", net).orderBy(F.desc("order_date"))


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return customers.select("customer_id").join(orders.select("customer_id"), "customer_id", "left_anti")
