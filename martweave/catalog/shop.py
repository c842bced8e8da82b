"""Registered shop queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.addresses import address_key
from ..functions.plan import once, once_all
from ..functions.text import browser, device_type
from ..operators.quality import duplicate_keys
from ..operators.innermost import innermost
from ..operators.ranges import range_lookup
from ..operators.upsert import merge_upsert
from ..plans import behaviour as B
from ..plans import commerce as C
from ..sources.sinks import expire
from . import standins as S
from .common import Catalog, big, day, dbl, moment, plain, quoted, rounded

catalog = Catalog()

CUTOFF = "2024-01-24T00:00:00+00:00"
AS_OF = "2024-01-31 00:00:00"


def events(spark, folder):
    return S.SHOP_EVENTS.frame(spark, folder)


# --- validation -------------------------------------------------------------------------

_EVENT_REASON_SQL = f"""case when topic = 'clicks' then case event_id % 60 when 59 then 'unexpected topic: clicks' end
  else case event_id % 60 when 1 then 'invalid JSON' when 2 then 'missing required field: ''type'''
  when 3 then 'missing required field: ''type''' when 4 then 'missing required field: ''type'''
  when 5 then 'missing required field: ''user_id''' when 6 then 'missing required field: ''session_id'''
  when 7 then 'missing required field: ''session_id'''
  else case when kind = 'error' then 'invalid event type: ''error'''
    when event_id % 60 = 8 then 'unparseable timestamp: ''yesterday'''
    when event_id % 60 = 9 then 'unparseable timestamp: ''2024-13-01T00:00:00''' end end end"""
_EVENT_TOPIC_SQL = f"""(select m.*, t.type kind from {S.TOPIC_EVENTS.sql} m join {S.SHOP_EVENTS.sql} t on t.event_id = m.event_id)"""


def topic_events(spark, folder):
    return C.routed(S.TOPIC_EVENTS.frame(spark, folder))


@catalog.add(
    "event_validation",
    f"select event_id, topic, {_EVENT_REASON_SQL} reason from {_EVENT_TOPIC_SQL}",
)
def _(spark, folder):
    return plain(topic_events(spark, folder).select("event_id", "topic", "reason"))


_ORDER_REASON_SQL = """case o_orderkey % 40 when 1 then 'missing required field: ''items''' when 9 then 'invalid order status: ''lost'''
  when 3 then 'items must be a non-empty list' when 5 then 'order total must be non-negative'
  when 7 then 'order total must be non-negative' end"""


def topic_orders(spark, folder):
    return C.routed(S.TOPIC_ORDERS.frame(spark, folder))


@catalog.add("order_validation", f"select o_orderkey, {_ORDER_REASON_SQL} reason from {S.TOPIC_ORDERS.sql}")
def _(spark, folder):
    return plain(topic_orders(spark, folder).select("o_orderkey", "reason"))


@catalog.add(
    "refused_messages",
    f"""select topic original_topic, value original_value, {_EVENT_REASON_SQL} reason, '2024-02-01T00:00:00+00:00' failed_at
    from {_EVENT_TOPIC_SQL} where {_EVENT_REASON_SQL} is not null""",
)
def _(spark, folder):
    envelopes = C.refused(topic_events(spark, folder), F.lit("2024-02-01T00:00:00+00:00"))
    shape = "original_topic string, original_value string, reason string, failed_at string"
    return plain(envelopes.select(F.from_json("value", shape).alias("r")).select("r.*"))


# --- enrichment --------------------------------------------------------------------------

_AGENT_SQL = "lower(user_agent)"


def _fragments_sql(groups, default: str) -> str:
    arms = " ".join(
        f"when {' or '.join(f'contains({_AGENT_SQL}, {chr(39)}{x}{chr(39)})' for x in fragments)} then '{name}'"
        for name, fragments in groups
    )
    return f"case {arms} else '{default}' end"


_DEVICE_SQL = _fragments_sql(V.DEVICE_FRAGMENTS, V.DEVICE_DEFAULT)
_BROWSER_SQL = _fragments_sql(V.BROWSER_FRAGMENTS, V.BROWSER_DEFAULT)


@catalog.add(
    "device_browser",
    f"select event_id, {_DEVICE_SQL} device_type, {_BROWSER_SQL} browser from {S.SHOP_EVENTS.sql}",
)
def _(spark, folder):
    return plain(
        events(spark, folder).select(
            "event_id", device_type("user_agent").alias("device_type"), browser("user_agent").alias("browser")
        )
    )


@catalog.add(
    "geo_range_join",
    f"""select event_id, ip_number, country, country_code, city from {S.SHOP_EVENTS.sql} e
    left join {S.GEO_RANGES.sql} g on e.ip_number between g.range_start and g.range_end""",
)
def _(spark, folder):
    rows = events(spark, folder).select("event_id", "ip_number")
    ranges = S.GEO_RANGES.frame(spark, folder)
    return plain(range_lookup(rows, ranges, "ip_number", "range_start", "range_end", C.GEO_FIELDS, salts=4))


_NETWORKS_SQL = "(" + " union all ".join(f"select * from {n.sql}" for n in S.NETWORKS) + ")"


def _address(family, number):
    """A whole number below 2**32 as an address text of its family."""
    octets = [F.shiftright(number, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)]
    groups = [F.lower(F.hex(F.shiftright(number, bits).bitwiseAND(65535))) for bits in (16, 0)]
    return F.when(family == 0, F.concat_ws(".", *octets)).otherwise(F.concat(F.lit("2001:db8::"), F.concat_ws(":", *groups)))


@catalog.add(
    "network_owner",
    f"""with asked as (select event_id, event_id % 2 family, if(event_id % 41 = 3, null, ip_number) n from {S.SHOP_EVENTS.sql}),
    held as (select event_id, g.name network, row_number() over (partition by event_id order by g.low desc, g.high, g.name) r
      from asked a join {_NETWORKS_SQL} g on g.family = a.family and a.n between g.low and g.high)
    select event_id, network from asked left join (select * from held where r = 1) using (event_id)""",
)
def _(spark, folder):
    """The innermost of nested and overlapping networks, of both families, that holds an event's address."""
    named = [n.frame(spark, folder) for n in S.NETWORKS]
    networks = named[0].unionByName(named[1]).unionByName(named[2])
    networks = once_all(networks, {s: address_key(_address(F.col("family"), F.col(n))) for s, n in [("start", "low"), ("end", "high")]})
    text = F.when(F.col("event_id") % 41 == 3, "unknown").otherwise(_address(F.col("event_id") % 2, F.col("ip_number")))
    asked = once(events(spark, folder).select("event_id", "ip_number"), address_key(text), "address")
    owned = innermost(asked, networks.withColumnRenamed("name", "network"), "address", "start", "end", ["network"])
    return plain(owned.select("event_id", "network"))


@catalog.add(
    "enriched_events",
    f"""select e.type, e.user_id, t.ip_number // 16777216 octet, if(user_agent = '', null, {_DEVICE_SQL}) device_type,
    if(user_agent = '', null, {_BROWSER_SQL}) browser, country, country_code, city, count(*) n
    from (select event_id, {_EVENT_REASON_SQL} is null sound from {_EVENT_TOPIC_SQL}) m
    join {S.SHOP_EVENTS.sql} e on e.event_id = m.event_id
    join (select event_id, (user_id_no % 250) * 16777216 + k * 65536 + (event_id % 256) * 256 + 1 ip_number
      from (select event_id, cast(replace(user_id, 'usr_', '') as bigint) user_id_no,
        cast(json_extract_string(props, '$.k') as bigint) k from {S.SHOP_EVENTS.sql} join (select event_id, props from events) using (event_id))) t
      on t.event_id = e.event_id
    left join {S.GEO_RANGES.sql} g on t.ip_number between g.range_start and g.range_end
    where m.sound group by all""",
)
def _(spark, folder):
    """Sound events of the topic with place, device and browser, counted per distinct outcome."""
    enriched = C.enrich_events(
        C.decoded_events(topic_events(spark, folder)), S.GEO_RANGES.frame(spark, folder), salts=2
    )
    octet = F.split("metadata.ip", r"\.")[0].cast("bigint")
    return plain(
        enriched.groupBy(
            "type",
            "user_id",
            octet.alias("octet"),
            *[F.col(f"metadata.{c}").alias(c) for c in ["device_type", "browser", "country", "country_code", "city"]],
        ).agg(F.count(F.lit(1)).alias("n"))
    )


# --- upserts -------------------------------------------------------------------------------


@catalog.add(
    "order_upsert",
    f"""with docs as (select * from (select o_orderkey, o_orderkey // 2 doc, o_custkey, o_totalprice, o_orderpriority,
      o_orderstatus, {_ORDER_REASON_SQL} reason from orders)),
    base as (select if(o_orderkey % 3 = 0, 'ORD-', 'OLD-') || o_orderkey id from orders),
    newest as (select doc, max(o_orderkey) last_key, max(o_orderkey) filter (o_orderkey % 2 = 0) last_even from docs where reason is null group by doc)
    select coalesce(b.id, 'ORD-' || n.doc) order_id, if(n.doc is null, 'usr_old', 'usr_' || l.o_custkey) user_id,
    if(n.doc is null, 'pending', {quoted(V.DOC_ORDER_STATUSES).join(['[', ']'])}[last_key % 6 + 1]) status,
    {dbl('if(n.doc is null, 1.0, cast(l.o_totalprice as decimal(18,2)))')} total,
    case when last_even is not null then e.o_orderpriority when b.id is not null then 'Old Town' end city
    from base b full join newest n on 'ORD-' || n.doc = b.id left join docs l on l.o_orderkey = n.last_key
    left join docs e on e.o_orderkey = n.last_even""",
)
def _(spark, folder):
    """Stored orders with two updates per order id, the second without an address, which must survive."""
    updates = C.decoded_orders(topic_orders(spark, folder))
    # two thirds of the stored orders have ids that no update names
    prefix = F.when(F.col("o_orderkey") % 3 == 0, F.lit("ORD-")).otherwise(F.lit("OLD-"))
    stored = S.TOPIC_ORDERS.frame(spark, folder).select(
        F.concat(prefix, F.col("o_orderkey").cast("string")).alias("order_id"),
        F.lit("usr_old").alias("user_id"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("array<struct<product_id:string,name_snapshot:string,unit_price:double,quantity:int>>").alias("items"),
        F.from_json(F.lit('{"total":1.0}'), "subtotal double, tax double, shipping double, total double").alias("totals"),
        F.lit("pending").alias("status"),
        F.from_json(
            F.lit('{"city":"Old Town"}'), "line1 string, line2 string, city string, postal_code string, country string"
        ).alias("shipping_address"),
        F.lit("2023-12-01T00:00:00").alias("created_at"),
    )
    merged = merge_upsert(stored, updates, "order_id", "position", "present")
    return plain(
        merged.select(
            "order_id", "user_id", "status", F.col("totals.total").alias("total"), F.col("shipping_address.city").alias("city")
        )
    )


@catalog.add(
    "rate_upsert",
    """select coalesce(s.pair, q.pair) currency_pair, coalesce(new_rate, 1.0) exchange_rate
    from (select 'N' || n_nationkey || '/USD' pair from nation) s
    full join (select 'N' || c_nationkey || if(c_nationkey < 10, '/EUR', '/USD') pair, arg_max(c_acctbal, c_custkey) new_rate
      from customer group by c_nationkey) q on q.pair = s.pair""",
)
def _(spark, folder):
    """Rates keyed by pair: the latest quote wins, unquoted pairs stay, new pairs are added."""
    from ..sources.tables import table

    def pair(key: str, currency):
        return F.concat(F.lit("N"), F.col(key).cast("string"), currency).alias("currency_pair")

    stored = table(spark, folder, "nation").select(pair("n_nationkey", F.lit("/USD")), F.lit(1.0).alias("exchange_rate"))
    quoted_in = F.when(F.col("c_nationkey") < 10, F.lit("/EUR")).otherwise(F.lit("/USD"))
    quotes = table(spark, folder, "customer").select(
        pair("c_nationkey", quoted_in), F.col("c_acctbal").alias("exchange_rate"), F.col("c_custkey").alias("quoted")
    )
    return plain(merge_upsert(stored, quotes, "currency_pair", "quoted"))


@catalog.add(
    "uniqueness_guard",
    """select l_orderkey, l_linenumber::bigint l_linenumber, count(*) "rows" from lineitem group by all having count(*) > 1""",
)
def _(spark, folder):
    from ..sources.tables import table

    return plain(duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]))


# --- product stats -------------------------------------------------------------------------

_RECENT_SQL = f"""(select * from {S.SHOP_EVENTS.sql} where "timestamp" >= '{CUTOFF}' and product_id is not null
  and type in ('page_view', 'purchase'))"""
_STATS_SQL = f"""(select product_id, v views_7d, p purchases_7d, if(v > 0, {rounded('p / nullif(v, 0)', 4)}, 0.0) conversion_rate
  from (select product_id, count(*) filter (type = 'page_view') v, count(*) filter (type = 'purchase') p from {_RECENT_SQL} group by product_id))"""


@catalog.add("event_type_counts", f"select product_id, type, count(*) count from {_RECENT_SQL} group by product_id, type")
def _(spark, folder):
    return plain(C.event_type_counts(events(spark, folder), CUTOFF))


@catalog.add("product_stats_7d", f"select * from {_STATS_SQL}")
def _(spark, folder):
    return plain(C.product_event_stats(events(spark, folder), CUTOFF))


@catalog.add(
    "product_stats_update",
    f"""select 'SKU-' || p_partkey sku, coalesce(views_7d, 7) views_7d, coalesce(purchases_7d, 1) purchases_7d,
    coalesce(conversion_rate, 0.5) conversion_rate from part left join {_STATS_SQL} s on s.product_id = 'SKU-' || p_partkey""",
)
def _(spark, folder):
    from ..sources.tables import table

    products = table(spark, folder, "part").select(
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.struct(
            F.lit(7).cast("bigint").alias("views_7d"), F.lit(1).cast("bigint").alias("purchases_7d"), F.lit(0.5).alias("conversion_rate")
        ).alias("stats"),
    )
    updated = C.update_product_stats(products, C.product_event_stats(events(spark, folder), CUTOFF))
    return plain(updated.select("sku", "stats.*"))


@catalog.add(
    "events_retention",
    f"""select event_id, if(ts < timestamp '{AS_OF}' - interval 20 day, 'events_archive', 'events') place
    from {S.SHOP_EVENTS.sql}""",
)
def _(spark, folder):
    """Where each event lives after a retention run; 20 days here, as the data spans 30."""
    kept, expired = expire(events(spark, folder), C.event_time(), AS_OF, 20)
    return plain(
        kept.select("event_id", F.lit("events").alias("place")).unionByName(
            expired.select("event_id", F.lit("events_archive").alias("place"))
        )
    )


@catalog.add(
    "order_pricing",
    f"""select order_id, user_id, session_id, product_id, {dbl('price')} unit_price, {big('quantity')} quantity,
    {dbl('subtotal')} subtotal, {dbl('tax')} tax, {dbl('shipping')} shipping, {dbl('subtotal + tax + shipping')} total,
    'pending' status, created_at
    from (select *, cast(cast(subtotal * cast({V.TAX_RATE} as decimal(5,4)) as decimal(18,2)) as decimal(18,2)) tax
      from (select 'ORD-' || event_id order_id, user_id, session_id, product_id, value price, event_id % 4 + 1 quantity,
        cast(value * (event_id % 4 + 1) as decimal(18,2)) subtotal, cast(event_id % 1599 as decimal(18,2)) * cast(0.01 as decimal(3,2)) shipping,
        "timestamp" created_at from {S.SHOP_EVENTS.sql} where type = 'purchase' and product_id is not null))""",
)
def _(spark, folder):
    purchases = events(spark, folder).filter((F.col("type") == "purchase") & F.col("product_id").isNotNull())
    key = F.col("event_id")
    orders = C.order_from_purchase(
        purchases,
        F.concat(F.lit("ORD-"), key.cast("string")),
        key % 4 + 1,
        F.col("value"),
        (key % 1599).cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)"),
    )
    item = F.col("items")[0]
    return plain(
        orders.select(
            "order_id",
            "user_id",
            "session_id",
            item["product_id"].alias("product_id"),
            item["unit_price"].alias("unit_price"),
            item["quantity"].alias("quantity"),
            "totals.*",
            "status",
            "created_at",
        )
    )


# --- behaviour reports -----------------------------------------------------------------------


@catalog.add(
    "revenue_by_day",
    f"""select {moment("date_trunc('day', o_orderdate)")} period, count(*) orders, {dbl('sum(cast(o_totalprice as decimal(18,2)))')} revenue
    from orders group by date_trunc('day', o_orderdate)""",
)
def _(spark, folder):
    return plain(B.revenue_by(_priced_orders(spark, folder), "o_orderdate", "price", "day"))


@catalog.add(
    "revenue_by_week",
    f"""select {moment("date_trunc('week', o_orderdate)")} period, count(*) orders, {dbl('sum(cast(o_totalprice as decimal(18,2)))')} revenue
    from orders group by date_trunc('week', o_orderdate)""",
)
def _(spark, folder):
    return plain(B.revenue_by(_priced_orders(spark, folder), "o_orderdate", "price", "week"))


@catalog.add(
    "revenue_by_hour",
    f"""select {moment("date_trunc('hour', ts)")} period, count(*) orders, {dbl('sum(value)')} revenue
    from {S.SHOP_EVENTS.sql} where type = 'purchase' group by date_trunc('hour', ts)""",
)
def _(spark, folder):
    purchases = events(spark, folder).filter(F.col("type") == "purchase")
    return plain(B.revenue_by(purchases, "ts", "value", "hour"))


def _priced_orders(spark, folder):
    from ..sources.tables import table

    return table(spark, folder, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))


_SESSIONS_SQL = f"""(select session_id, bool_or(type = 'page_view') v, bool_or(type = 'add_to_cart') c, bool_or(type = 'purchase') p
  from {S.SHOP_EVENTS.sql} group by session_id)"""


@catalog.add(
    "funnel",
    f"""select v view_sessions, c cart_sessions, p purchase_sessions, {rounded('c / v', 4)} cart_rate, {rounded('p / v', 4)} purchase_rate
    from (select count(*) filter (v) v, count(*) filter (v and c) c, count(*) filter (v and c and p) p from {_SESSIONS_SQL})""",
)
def _(spark, folder):
    return plain(B.funnel(events(spark, folder)))


@catalog.add(
    "cart_abandonment",
    f"""select n cart_sessions, a abandoned_sessions, {rounded('a / n', 4)} abandonment_rate
    from (select count(*) n, count(*) filter (not p) a from {_SESSIONS_SQL} where c)""",
)
def _(spark, folder):
    return plain(B.cart_abandonment(events(spark, folder)))


@catalog.add(
    "top_products_by_revenue",
    f"""select l_partkey, {dbl('sum(cast(l_extendedprice as decimal(18,2)))')} revenue from lineitem group by l_partkey
    order by sum(cast(l_extendedprice as decimal(18,2))) desc, l_partkey limit 10""",
)
def _(spark, folder):
    from ..sources.tables import table

    lines = table(spark, folder, "lineitem")
    return plain(B.top_products(lines, "l_partkey", F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), 10, "revenue"))


@catalog.add(
    "top_products_by_views",
    f"""select product_id, count(*) views from {S.SHOP_EVENTS.sql} where type = 'page_view' and product_id is not null
    group by product_id order by views desc, product_id limit 10""",
)
def _(spark, folder):
    views = events(spark, folder).filter((F.col("type") == "page_view") & F.col("product_id").isNotNull())
    return plain(B.top_products(views, "product_id", F.count(F.lit(1)), 10, "views"))


@catalog.add(
    "rfm_segments",
    f"""select *, concat_ws(',', if(monetary_total > 3000000, 'high_value', null), if(frequency > 10, 'repeat_buyer', null),
    if(recency_days > 300, 'dormant', null)) segments
    from (select o_custkey, date_diff('day', max(cast(o_orderdate as date)), date '2002-01-01') recency_days, count(*) frequency,
    {dbl('sum(cast(o_totalprice as decimal(18,2)))')} monetary_total from orders group by o_custkey)""",
)
def _(spark, folder):
    scores = B.rfm(_priced_orders(spark, folder), "o_custkey", "o_orderdate", "price", "2002-01-01")
    rules = [
        (F.col("monetary_total") > 3000000, "high_value"),
        (F.col("frequency") > 10, "repeat_buyer"),
        (F.col("recency_days") > 300, "dormant"),
    ]
    return plain(B.rfm_segments(scores, rules))


@catalog.add(
    "recent_orders",
    """select o_custkey, string_agg(o_orderkey::varchar, ',' order by o_orderdate desc, o_orderkey desc) order_ids, count(*) n
    from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) r from orders)
    where r <= 10 group by o_custkey""",
)
def _(spark, folder):
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    lists = B.recent_orders(_priced_orders(spark, folder), "o_custkey", newest, ["o_orderkey", "price", "o_orderstatus"])
    ids = F.transform("recent_orders", lambda x: x["o_orderkey"].cast("string"))
    return plain(lists.select("o_custkey", F.array_join(ids, ",").alias("order_ids"), F.size("recent_orders").alias("n")))


@catalog.add(
    "orders_by_geography",
    f"""select r_name, n_name, count(*) orders, {dbl('sum(cast(o_totalprice as decimal(18,2)))')} revenue from orders
    join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
    group by r_name, n_name""",
)
def _(spark, folder):
    """Revenue is summed per customer first, so the place joins see one row per customer."""
    from ..sources.tables import tables

    customer, nation, region = tables(spark, folder, "customer", "nation", "region")
    per_customer = _priced_orders(spark, folder).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price")
    )
    placed = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return plain(
        placed.groupBy("r_name", "n_name").agg(F.sum("n").alias("orders"), F.sum("price").alias("revenue"))
    )


@catalog.add(
    "device_conversion",
    f"""select device_type, v views, p purchases, {rounded('p / nullif(v, 0)', 4)} conversion_rate from (select {_DEVICE_SQL} device_type,
    count(*) filter (type = 'page_view') v, count(*) filter (type = 'purchase') p from {S.SHOP_EVENTS.sql} group by 1)""",
)
def _(spark, folder):
    rows = events(spark, folder).withColumn("device_type", device_type("user_agent"))
    return plain(B.device_conversion(rows))


@catalog.add(
    "order_total_gaps",
    f"""select 'ORD-' || event_id order_id, {dbl('value * (event_id % 4 + 1)')} line_total, 1.0::double as gap from {S.SHOP_EVENTS.sql}
    where type = 'purchase' and product_id is not null and event_id % 6 = 0""",
)
def _(spark, folder):
    """Orders whose stored subtotal was made to differ by one."""
    purchases = events(spark, folder).filter((F.col("type") == "purchase") & F.col("product_id").isNotNull())
    key = F.col("event_id")
    orders = C.order_from_purchase(
        purchases.withColumn("session_id", key.cast("string")),
        F.concat(F.lit("ORD-"), key.cast("string")), key % 4 + 1, F.col("value"), F.lit(0),
    )
    off = F.when(F.col("session_id").cast("bigint") % 6 == 0, 1.0).otherwise(0.0)
    damaged = orders.withColumn("totals", F.col("totals").withField("subtotal", F.col("totals.subtotal") + off))
    return plain(B.order_total_gaps(damaged))
