"""Shop events, orders and products: decoding, enrichment, upserts, nightly product stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import wall_clock
from ..functions.messages import TOPIC_MEMBERS, member, refusal_envelope, topic_error, with_document
from ..functions.text import browser, device_type, ipv4_number
from ..operators.ranges import range_lookup

EVENT_SCHEMA = (
    "type string, user_id string, session_id string, product_id string, timestamp string, "
    "metadata struct<ip: string, user_agent: string, country: string, country_code: string, "
    "city: string, device_type: string, browser: string>"
)
ORDER_SCHEMA = (
    "order_id string, user_id string, session_id string, "
    "items array<struct<product_id: string, name_snapshot: string, unit_price: double, quantity: int>>, "
    "totals struct<subtotal: double, tax: double, shipping: double, total: double>, status string, "
    "shipping_address struct<line1: string, line2: string, city: string, postal_code: string, country: string>, "
    "created_at string"
)
ORDER_FIELDS = [
    "order_id", "user_id", "session_id", "items", "totals", "status", "shipping_address", "created_at",
]
GEO_FIELDS = ["country", "country_code", "city"]


def routed(messages: DataFrame) -> DataFrame:
    """Topic records (topic, value, ...) with the decoded document and the reason for refusal, if any."""
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    decoded = with_document(messages, text, TOPIC_MEMBERS)
    return decoded.withColumn("reason", topic_error(F.col("topic"))).drop("m")


def refused(routed_rows: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """One JSON envelope per refused record."""
    stamp = failed_at if failed_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    bad = routed_rows.filter(F.col("reason").isNotNull())
    return bad.select(refusal_envelope(F.col("topic"), F.col("value"), F.col("reason"), stamp).alias("value"))


def _as_struct(schema: str) -> Column:
    """The parsed document as a struct; members of another type than expected are null."""
    return F.from_json("value", schema)


def decoded_events(routed_rows: DataFrame) -> DataFrame:
    good = routed_rows.filter((F.col("topic") == "events") & F.col("reason").isNull())
    return good.select(_as_struct(EVENT_SCHEMA).alias("e")).select("e.*")


def decoded_orders(routed_rows: DataFrame) -> DataFrame:
    """Sound orders with the list of fields each document carries and its position in the topic.

    Offsets count within a partition of the topic, so the position is (partition, offset).
    """
    partition = F.col("partition") if "partition" in routed_rows.columns else F.lit(0)
    good = routed_rows.filter((F.col("topic") == "orders") & F.col("reason").isNull())
    present = F.array_compact(
        F.array(*[F.when(member(F.col("doc"), f".{f}", "variant").isNotNull(), F.lit(f)) for f in ORDER_FIELDS])
    )
    return good.select(
        _as_struct(ORDER_SCHEMA).alias("o"), present.alias("present"), F.struct(partition.alias("partition"), "offset").alias("position")
    ).select("o.*", "present", "position")


def _filled(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def enrich_events(events: DataFrame, geo_ranges: DataFrame | None = None, salts: int = 1) -> DataFrame:
    """Device and browser from the user agent, place from the IP range; each only where its source is there.

    An event without metadata gets an empty metadata object.
    """
    ip, agent = F.col("metadata.ip"), F.col("metadata.user_agent")
    metadata = F.coalesce(F.col("metadata"), F.from_json(F.lit("{}"), _metadata_type(events)))
    with_device = metadata.withField(
        "device_type", F.when(_filled(agent), device_type(agent)).otherwise(metadata["device_type"])
    ).withField("browser", F.when(_filled(agent), browser(agent)).otherwise(metadata["browser"]))
    events = events.withColumn("metadata", with_device)
    if geo_ranges is None:
        return events
    found = {f: f"_geo_{f}" for f in GEO_FIELDS}
    ranges = geo_ranges.select(
        "range_start", "range_end", *[F.col(f).alias(a) for f, a in found.items()]
    )
    located = range_lookup(
        events.withColumn("_ip", ipv4_number(ip)), ranges, "_ip", "range_start", "range_end",
        list(found.values()), salts=salts,
    )
    place = F.col("metadata")
    for name, alias in found.items():
        place = place.withField(name, F.coalesce(F.col(alias), F.col(f"metadata.{name}")))
    return located.withColumn("metadata", place).drop("_ip", *found.values())


def _metadata_type(events: DataFrame) -> str:
    return events.schema["metadata"].dataType.simpleString()


def product_event_stats(events: DataFrame, cutoff: str) -> DataFrame:
    """Views, purchases and conversion per product since `cutoff`; times compare as ISO text.

    Both counts are conditional counts in one aggregate, combined before the shuffle.
    """
    views, buys = F.col("views_7d"), F.col("purchases_7d")
    recent = events.filter(
        (F.col("timestamp") >= cutoff)
        & F.col("type").isin("page_view", "purchase")
        & F.col("product_id").isNotNull()
    )
    return (
        recent.groupBy("product_id")
        .agg(
            F.count_if(F.col("type") == "page_view").alias("views_7d"),
            F.count_if(F.col("type") == "purchase").alias("purchases_7d"),
        )
        .withColumn(
            "conversion_rate", F.when(views > 0, F.round(buys / views, 4)).otherwise(F.lit(0.0))
        )
    )


def event_type_counts(events: DataFrame, cutoff: str) -> DataFrame:
    """Events per product and type since `cutoff`."""
    recent = events.filter(
        (F.col("timestamp") >= cutoff)
        & F.col("type").isin("page_view", "purchase")
        & F.col("product_id").isNotNull()
    )
    return recent.groupBy("product_id", "type").agg(F.count(F.lit(1)).alias("count"))


def update_product_stats(products: DataFrame, stats: DataFrame) -> DataFrame:
    """Products with new stats where there were events; others keep theirs, unknown products are dropped."""
    new = stats.select(
        F.col("product_id").alias("sku"), F.struct("views_7d", "purchases_7d", "conversion_rate").alias("_new")
    )
    kind = products.schema["stats"].dataType.simpleString()
    return (
        products.join(new, "sku", "left")
        .withColumn("stats", F.coalesce(F.col("_new").cast(kind), F.col("stats")))
        .select(*products.columns)
    )


def price_order(quantity: Column, unit_price: Column, shipping: Column, tax_rate: float = V.TAX_RATE) -> Column:
    """Totals object of a one-line order."""
    money = "decimal(18,2)"
    subtotal = F.round(unit_price.cast(money) * quantity, 2).cast(money)
    tax = F.round(subtotal * F.lit(tax_rate).cast("decimal(5,4)"), 2).cast(money)
    cost = shipping.cast(money)
    total = (subtotal + tax + cost).cast(money)
    return F.struct(
        subtotal.cast("double").alias("subtotal"),
        tax.cast("double").alias("tax"),
        cost.cast("double").alias("shipping"),
        total.cast("double").alias("total"),
    )


def order_from_purchase(
    purchases: DataFrame, order_id: Column, quantity: Column, unit_price: Column, shipping: Column
) -> DataFrame:
    """Pending order per purchase event, the product and its price kept as a snapshot."""
    item = F.struct(
        F.col("product_id").alias("product_id"),
        F.col("product_id").alias("name_snapshot"),
        unit_price.cast("double").alias("unit_price"),
        quantity.cast("int").alias("quantity"),
    )
    return purchases.select(
        order_id.alias("order_id"),
        "user_id",
        "session_id",
        F.array(item).alias("items"),
        price_order(quantity, unit_price, shipping).alias("totals"),
        F.lit("pending").alias("status"),
        F.col("timestamp").alias("created_at"),
    )


def event_time() -> Column:
    """The event's own time as an instant; null when it is not ISO text."""
    return F.when(wall_clock("timestamp").isNotNull(), F.col("timestamp").try_cast("timestamp"))
