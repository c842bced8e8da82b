"""Marketplace marts: staging of eleven raw tables, order facts, sellers, attribution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import days_between
from ..operators.distinct import with_distinct_counts


def _staged(raw: DataFrame, keys: list[str], columns: Mapping[str, str], dates: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with all `keys` present; `columns` maps new to raw names, `dates` likewise with a cast to date."""
    for key in keys:
        raw = raw.filter(F.col(key).isNotNull())
    picked = [F.col(old).alias(new) for new, old in columns.items()]
    picked += [F.to_date(old).alias(new) for new, old in (dates or {}).items()]
    return raw.select(*picked)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def stage_orders(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["order_id", "order_purchase_timestamp"],
        _same("order_id", "customer_id", "order_status"),
        {
            "purchase_date": "order_purchase_timestamp",
            "approved_date": "order_approved_at",
            "delivered_carrier_date": "order_delivered_carrier_date",
            "delivered_customer_date": "order_delivered_customer_date",
            "estimated_delivery_date": "order_estimated_delivery_date",
        },
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["order_id"],
        _same("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        {"shipping_due_date": "shipping_limit_date"},
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["order_id"],
        _same("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    )


def stage_reviews(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["review_id", "order_id"],
        _same("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message"),
        _same("review_creation_date", "review_answer_timestamp"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["customer_id", "customer_unique_id"],
        _same(
            "customer_id", "customer_unique_id", "customer_state", "customer_zip_code_prefix", "customer_city"
        ),
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["seller_id"],
        {
            "seller_id": "seller_id",
            "zip_code_prefix": "seller_zip_code_prefix",
            "city": "seller_city",
            "state": "seller_state",
        },
    )


def stage_categories(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["product_category_name"],
        {"category_name": "product_category_name", "category_name_english": "product_category_name_english"},
    )


def stage_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category name, null where none is known."""
    named = raw.join(
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )
    return _staged(
        named,
        ["product_id"],
        {
            "product_id": "product_id",
            "category_name": "product_category_name_english",
            "name_lenght": "product_name_lenght",
            "description_lenght": "product_description_lenght",
            "photos_qty": "product_photos_qty",
            "weight_g": "product_weight_g",
            "length_cm": "product_length_cm",
            "height_cm": "product_height_cm",
            "width_cm": "product_width_cm",
        },
    )


def stage_geolocation(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["geolocation_lat", "geolocation_lng"],
        {
            "city": "geolocation_city",
            "latitude": "geolocation_lat",
            "longitude": "geolocation_lng",
            "state": "geolocation_state",
            "zip_code_prefix": "geolocation_zip_code_prefix",
        },
    )


def stage_leads(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["mql_id", "first_contact_date"],
        {
            "marketing_qualified_lead_id": "mql_id",
            "landing_page_id": "landing_page_id",
            "marketing_channel": "origin",
        },
        _same("first_contact_date"),
    )


def stage_deals(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        ["mql_id", "won_date"],
        {
            "marketing_qualified_lead_id": "mql_id",
            "seller_id": "seller_id",
            "sales_developer_id": "sdr_id",
            "sales_representative_id": "sr_id",
            "associated_to_a_company": "has_company",
            "has_global_trade_item_number": "has_gtin",
            **_same(
                "average_stock",
                "business_segment",
                "business_type",
                "declared_monthly_revenue",
                "declared_product_catalog_size",
                "lead_behaviour_profile",
                "lead_type",
            ),
        },
        {"deal_close_date": "won_date"},
    )


def order_items_rollup(items: DataFrame) -> DataFrame:
    """Totals per order."""
    totals = with_distinct_counts(
        items,
        ["order_id"],
        {"unique_products_count": "product_id", "unique_sellers_count": "seller_id"},
        {
            "_price": F.sum("price"),
            "_freight": F.sum("freight_value"),
            "_value": F.sum(F.col("price") + F.col("freight_value")),
            "_items": F.count("order_item_id"),
        },
        {
            "total_items_price": F.sum("_price"),
            "total_freight_value": F.sum("_freight"),
            "total_order_item_value": F.sum("_value"),
            "total_items_count": F.sum("_items"),
        },
    )
    return totals.select("order_id", *ROLLUP_DEFAULTS)


ROLLUP_DEFAULTS = [
    "total_items_price",
    "total_freight_value",
    "total_order_item_value",
    "unique_products_count",
    "unique_sellers_count",
    "total_items_count",
]


def order_facts(orders: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row per order with item totals (0 without items), delivery durations and status."""
    delivered, estimate = F.col("delivered_customer_date"), F.col("estimated_delivery_date")
    return orders.join(rollup, "order_id", "left").select(
        *orders.columns,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ROLLUP_DEFAULTS],
        days_between(delivered, "purchase_date").alias("actual_delivery_duration_days"),
        days_between(estimate, "approved_date").alias("estimated_delivery_duration_days"),
        days_between(delivered, estimate).alias("delivery_delta_vs_estimated_days"),
        days_between("delivered_carrier_date", "approved_date").alias("seller_handling_duration_days"),
        F.when(delivered.isNull(), V.DELIVERY_OPEN)
        .when(delivered <= estimate, V.DELIVERY_ON_TIME)
        .otherwise(V.DELIVERY_LATE)
        .alias("delivery_performance_status"),
    )


def closed_leads(leads: DataFrame, deals: DataFrame) -> DataFrame:
    return leads.join(deals, "marketing_qualified_lead_id", "left").select(
        "marketing_qualified_lead_id",
        "seller_id",
        "sales_developer_id",
        "sales_representative_id",
        "first_contact_date",
        "landing_page_id",
        F.coalesce("marketing_channel", F.lit(V.CHANNEL_UNKNOWN)).alias("marketing_channel"),
        "deal_close_date",
        "business_segment",
        "lead_type",
        "lead_behaviour_profile",
        "business_type",
        F.col("seller_id").isNotNull().alias("is_won_deal"),
    )


def seller_dimension(sellers: DataFrame, leads: DataFrame) -> DataFrame:
    """One row per seller and won lead; sellers without one count as organic."""
    funnel = leads.filter(F.col("seller_id").isNotNull()).withColumn("_matched", F.lit(True))
    return sellers.join(funnel, "seller_id", "left").select(
        "seller_id",
        "marketing_qualified_lead_id",
        "sales_developer_id",
        "sales_representative_id",
        "landing_page_id",
        "zip_code_prefix",
        "city",
        "state",
        F.coalesce("marketing_channel", F.lit(V.CHANNEL_ORGANIC)).alias("marketing_channel"),
        "first_contact_date",
        "deal_close_date",
        "business_segment",
        "lead_type",
        "lead_behaviour_profile",
        "business_type",
        F.col("_matched").isNotNull().alias("is_funnel_acquired"),
    )


def seller_attribution(orders: DataFrame, items: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per order and seller, each carrying the totals of the whole order.

    The item table is read once: per-(order, seller) sums are combined before the shuffle
    and the order totals are a window over them, which holds at most one row per seller of
    the order.  The window's partitioning by order then serves the join with the orders.
    An order's totals are repeated for each of its sellers, as the model defines.
    """
    per_seller = items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("_price"),
        F.sum("freight_value").alias("_freight"),
        F.sum(F.col("price") + F.col("freight_value")).alias("_value"),
        F.count("order_item_id").alias("_items"),
    )
    whole_order = Window.partitionBy("order_id")
    mapped = per_seller.select(
        "order_id",
        "seller_id",
        *[
            F.coalesce(F.sum(source).over(whole_order), F.lit(0)).alias(name)
            for name, source in [
                ("attributed_revenue", "_price"),
                ("attributed_freight", "_freight"),
                ("attributed_total_value", "_value"),
                ("total_items_count", "_items"),
            ]
        ],
    )
    facts = orders.select("order_id", "customer_id", "order_status", "purchase_date").join(
        mapped, "order_id", "inner"
    )
    dimension = sellers.select(
        "seller_id",
        "marketing_channel",
        "sales_developer_id",
        "sales_representative_id",
        "is_funnel_acquired",
        F.col("city").alias("seller_city"),
        F.col("state").alias("seller_state"),
    )
    return facts.join(dimension, "seller_id", "left").select(
        "order_id",
        "customer_id",
        "seller_id",
        "order_status",
        "purchase_date",
        "marketing_channel",
        "sales_developer_id",
        "sales_representative_id",
        "is_funnel_acquired",
        "seller_city",
        "seller_state",
        "attributed_revenue",
        "attributed_freight",
        "attributed_total_value",
        "total_items_count",
    )
