"""Registered marketplace queries."""

from __future__ import annotations

from .. import fixed_values as V
from ..plans import marketplace as M
from . import standins as S
from .common import Catalog, big, day, dbl, plain, shared

catalog = Catalog()

DATES = ["purchase_date", "approved_date", "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date"]
_ORDERS_SQL = f"""(select order_id, customer_id, order_status, cast(order_purchase_timestamp as date) purchase_date,
  order_approved_at approved_date, order_delivered_carrier_date delivered_carrier_date,
  order_delivered_customer_date delivered_customer_date, order_estimated_delivery_date estimated_delivery_date
  from {S.RAW_ORDERS.sql} where order_id is not null)"""


def staged_orders(spark, folder):
    return M.stage_orders(S.RAW_ORDERS.frame(spark, folder))


def staged_items(spark, folder):
    return M.stage_order_items(S.RAW_ITEMS.frame(spark, folder))


def leads_and_deals(spark, folder):
    return shared(
        folder,
        "leads",
        lambda: M.closed_leads(M.stage_leads(S.RAW_LEADS.frame(spark, folder)), M.stage_deals(S.RAW_DEALS.frame(spark, folder))),
    )


def sellers(spark, folder):
    return shared(
        folder,
        "sellers",
        lambda: M.seller_dimension(M.stage_sellers(S.RAW_SELLERS.frame(spark, folder)), leads_and_deals(spark, folder)),
    )


def rollup(spark, folder):
    return shared(folder, "order_items", lambda: M.order_items_rollup(staged_items(spark, folder)))


def facts(spark, folder):
    return shared(folder, "order_facts", lambda: M.order_facts(staged_orders(spark, folder), rollup(spark, folder)))


@catalog.add(
    "staged_orders",
    f"select order_id, customer_id, order_status, {', '.join(f'{day(d)} {d}' for d in DATES)} from {_ORDERS_SQL}",
)
def _(spark, folder):
    return plain(staged_orders(spark, folder))


@catalog.add(
    "staged_order_items",
    f"""select order_id, {big('order_item_id')} order_item_id, product_id, seller_id,
    {day('shipping_limit_date')} shipping_due_date, {dbl('price')} price, {dbl('freight_value')} freight_value
    from {S.RAW_ITEMS.sql}""",
)
def _(spark, folder):
    return plain(staged_items(spark, folder))


@catalog.add(
    "staged_payments",
    f"""select order_id, {big('payment_sequential')} payment_sequential, payment_type,
    {big('payment_installments')} payment_installments, payment_value from {S.RAW_PAYMENTS.sql}
    where order_id is not null""",
)
def _(spark, folder):
    return plain(M.stage_payments(S.RAW_PAYMENTS.frame(spark, folder)))


@catalog.add(
    "staged_reviews",
    f"""select review_id, order_id, {big('review_score')} review_score, review_comment_title, review_comment_message,
    {day('review_creation_date')} review_creation_date, {day('review_answer_timestamp')} review_answer_timestamp
    from {S.RAW_REVIEWS.sql} where review_id is not null and order_id is not null""",
)
def _(spark, folder):
    return plain(M.stage_reviews(S.RAW_REVIEWS.frame(spark, folder)))


@catalog.add(
    "staged_market_customers",
    f"""select customer_id, customer_unique_id, customer_state, {big('customer_zip_code_prefix')} customer_zip_code_prefix,
    customer_city from {S.RAW_MARKET_CUSTOMERS.sql} where customer_unique_id is not null""",
)
def _(spark, folder):
    return plain(M.stage_customers(S.RAW_MARKET_CUSTOMERS.frame(spark, folder)))


@catalog.add(
    "staged_sellers",
    f"""select seller_id, {big('seller_zip_code_prefix')} zip_code_prefix, seller_city city, seller_state state
    from {S.RAW_SELLERS.sql}""",
)
def _(spark, folder):
    return plain(M.stage_sellers(S.RAW_SELLERS.frame(spark, folder)))


_CATEGORIES_SQL = f"(select distinct * from {S.RAW_CATEGORIES.sql})"


@catalog.add(
    "staged_categories",
    f"select product_category_name category_name, product_category_name_english category_name_english from {_CATEGORIES_SQL}",
)
def _(spark, folder):
    return plain(M.stage_categories(S.RAW_CATEGORIES.frame(spark, folder).distinct()))


@catalog.add(
    "staged_products",
    f"""select product_id, product_category_name_english category_name,
    {', '.join(f'{big("product_" + c)} {c}' for c in ['name_lenght', 'description_lenght', 'photos_qty', 'weight_g', 'length_cm', 'height_cm', 'width_cm'])}
    from {S.RAW_PRODUCTS.sql} left join {_CATEGORIES_SQL} using (product_category_name) where product_id is not null""",
)
def _(spark, folder):
    return plain(
        M.stage_products(S.RAW_PRODUCTS.frame(spark, folder), S.RAW_CATEGORIES.frame(spark, folder).distinct())
    )


@catalog.add(
    "staged_geolocation",
    f"""select geolocation_city city, geolocation_lat latitude, geolocation_lng longitude, geolocation_state state,
    {big('geolocation_zip_code_prefix')} zip_code_prefix from {S.RAW_GEOLOCATION.sql} where geolocation_lng is not null""",
)
def _(spark, folder):
    return plain(M.stage_geolocation(S.RAW_GEOLOCATION.frame(spark, folder)))


@catalog.add(
    "staged_leads",
    f"""select mql_id marketing_qualified_lead_id, landing_page_id, origin marketing_channel,
    {day('first_contact_date')} first_contact_date from {S.RAW_LEADS.sql} where mql_id is not null""",
)
def _(spark, folder):
    return plain(M.stage_leads(S.RAW_LEADS.frame(spark, folder)))


@catalog.add(
    "staged_deals",
    f"""select mql_id marketing_qualified_lead_id, seller_id, sdr_id sales_developer_id, sr_id sales_representative_id,
    has_company associated_to_a_company, has_gtin has_global_trade_item_number, average_stock, business_segment,
    business_type, declared_monthly_revenue, declared_product_catalog_size, lead_behaviour_profile, lead_type,
    {day('won_date')} deal_close_date from {S.RAW_DEALS.sql} where won_date is not null""",
)
def _(spark, folder):
    return plain(M.stage_deals(S.RAW_DEALS.frame(spark, folder)))


_ROLLUP_SQL = f"""(select order_id, sum(price) items_price, sum(freight_value) freight, sum(price + freight_value) item_value,
  count(distinct product_id) products, count(distinct seller_id) sellers, count(order_item_id) n
  from {S.RAW_ITEMS.sql} group by order_id)"""


@catalog.add(
    "order_items_rollup",
    f"""select order_id, {dbl('items_price')} total_items_price, {dbl('freight')} total_freight_value,
    {dbl('item_value')} total_order_item_value, products unique_products_count, sellers unique_sellers_count,
    n total_items_count from {_ROLLUP_SQL}""",
)
def _(spark, folder):
    return plain(rollup(spark, folder))


@catalog.add(
    "fct_orders",
    f"""select o.order_id, customer_id, order_status, {', '.join(f'{day(d)} {d}' for d in DATES)},
    coalesce({dbl('items_price')}, 0) total_items_price, coalesce({dbl('freight')}, 0) total_freight_value,
    coalesce({dbl('item_value')}, 0) total_order_item_value, coalesce(products, 0) unique_products_count,
    coalesce(sellers, 0) unique_sellers_count, coalesce(n, 0) total_items_count,
    date_diff('day', purchase_date, delivered_customer_date) actual_delivery_duration_days,
    date_diff('day', approved_date, estimated_delivery_date) estimated_delivery_duration_days,
    date_diff('day', estimated_delivery_date, delivered_customer_date) delivery_delta_vs_estimated_days,
    date_diff('day', approved_date, delivered_carrier_date) seller_handling_duration_days,
    if(delivered_customer_date is null, '{V.DELIVERY_OPEN}',
       if(delivered_customer_date > estimated_delivery_date, '{V.DELIVERY_LATE}', '{V.DELIVERY_ON_TIME}'))
      delivery_performance_status
    from {_ORDERS_SQL} o left join {_ROLLUP_SQL} r on r.order_id = o.order_id""",
)
def _(spark, folder):
    return plain(facts(spark, folder))


_LEADS_SQL = f"""(select l.mql_id lead_id, d.*, {day('first_contact_date')} first_contact, landing_page_id,
  coalesce(origin, '{V.CHANNEL_UNKNOWN}') channel
  from (select * from {S.RAW_LEADS.sql} where mql_id is not null) l
  left join (select seller_id, mql_id deal_lead, sdr_id, sr_id, {day('won_date')} close_date, business_segment, lead_type,
    lead_behaviour_profile, business_type from {S.RAW_DEALS.sql} where won_date is not null) d on d.deal_lead = l.mql_id)"""


@catalog.add(
    "closed_leads",
    f"""select lead_id marketing_qualified_lead_id, seller_id, sdr_id sales_developer_id, sr_id sales_representative_id,
    first_contact first_contact_date, landing_page_id, channel marketing_channel, close_date deal_close_date,
    business_segment, lead_type, lead_behaviour_profile, business_type, seller_id is not null is_won_deal
    from {_LEADS_SQL}""",
)
def _(spark, folder):
    return plain(leads_and_deals(spark, folder))


_SELLERS_SQL = f"""(select s.seller_id, lead_id marketing_qualified_lead_id, sdr_id sales_developer_id,
  sr_id sales_representative_id, landing_page_id, {big('seller_zip_code_prefix')} zip_code_prefix, seller_city city,
  seller_state state, coalesce(channel, '{V.CHANNEL_ORGANIC}') marketing_channel, first_contact first_contact_date,
  close_date deal_close_date, business_segment, lead_type, lead_behaviour_profile, business_type,
  l.seller_id is not null is_funnel_acquired
  from {S.RAW_SELLERS.sql} s left join {_LEADS_SQL} l on l.seller_id = s.seller_id)"""


@catalog.add("dim_sellers", f"select * from {_SELLERS_SQL}")
def _(spark, folder):
    return plain(sellers(spark, folder))


_ATTRIBUTION_SQL = f"""(select o.order_id, o.customer_id, p.seller_id, o.order_status, {day('purchase_date')} purchase_date,
  marketing_channel, sales_developer_id, sales_representative_id, is_funnel_acquired, city seller_city, state seller_state,
  {dbl('items_price')} attributed_revenue, {dbl('freight')} attributed_freight, {dbl('item_value')} attributed_total_value,
  n total_items_count
  from {_ORDERS_SQL} o
  join (select distinct order_id, seller_id from {S.RAW_ITEMS.sql}) p on p.order_id = o.order_id
  join {_ROLLUP_SQL} r on r.order_id = o.order_id
  left join {_SELLERS_SQL} s on s.seller_id = p.seller_id)"""


def attribution(spark, folder):
    return M.seller_attribution(staged_orders(spark, folder), staged_items(spark, folder), sellers(spark, folder))


@catalog.add("b2b2c_attribution", f"select * from {_ATTRIBUTION_SQL}")
def _(spark, folder):
    return plain(attribution(spark, folder))
