"""Logical inputs of the marts, derived from the given tables.

Each expression is plain arithmetic on keys, so both engines compute the same rows, and
every case that matters occurs: missing parts, late and early days, unknown keys, zero and
negative amounts.
"""

from __future__ import annotations

from .. import fixed_values as V
from .common import Standin, nth_sql

# --- marketplace ---------------------------------------------------------------

_APPROVED = "cast(o_orderdate as date) + cast(o_orderkey % 3 as int)"
_CARRIER = f"{_APPROVED} + cast(o_orderkey % 11 - case when o_orderkey % 143 = 0 then 2 else 0 end as int)"
_OPEN = "o_orderstatus = 'O'"

RAW_ORDERS = Standin(
    "orders",
    {
        "order_id": "case when o_orderkey % 997 = 5 then null else o_orderkey end",
        "customer_id": "o_custkey",
        "order_status": "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end",
        "order_purchase_timestamp": "o_orderdate",
        "order_approved_at": _APPROVED,
        "order_delivered_carrier_date": f"case when {_OPEN} then null else {_CARRIER} end",
        "order_delivered_customer_date": f"case when {_OPEN} then null else {_CARRIER} + cast(5 + o_orderkey % 70 as int) end",
        "order_estimated_delivery_date": "cast(o_orderdate as date) + 60",
    },
)
RAW_ITEMS = Standin(
    "lineitem",
    {
        "order_id": "l_orderkey",
        "order_item_id": "l_linenumber",
        "product_id": "l_partkey",
        "seller_id": "l_suppkey",
        "shipping_limit_date": "l_shipdate",
        # narrow enough that Spark sums it in a long
        "price": "cast(l_extendedprice as decimal(8,2))",
        "freight_value": "cast(cast(l_extendedprice as decimal(8,2)) * cast(l_tax as decimal(4,2)) as decimal(8,2))",
    },
)
RAW_PAYMENTS = Standin(
    "orders",
    {
        "order_id": "case when o_orderkey % 991 = 3 then null else o_orderkey end",
        "payment_sequential": "1",
        "payment_type": nth_sql("o_orderkey % 4", ["credit_card", "boleto", "voucher", "debit_card"]),
        "payment_installments": "o_orderkey % 12 + 1",
        "payment_value": "o_totalprice",
    },
)
RAW_REVIEWS = Standin(
    "documents",
    {
        "review_id": "case when doc_id % 89 = 1 then null else doc_id end",
        "order_id": "case when doc_id % 97 = 2 then null else doc_id * 3 end",
        "review_score": "doc_id % 5 + 1",
        "review_comment_title": "lang",
        "review_comment_message": "text",
        "review_creation_date": "date '1999-01-01' + cast(doc_id % 300 as int)",
        "review_answer_timestamp": "date '1999-01-03' + cast(doc_id % 300 as int)",
    },
)
RAW_MARKET_CUSTOMERS = Standin(
    "customer",
    {
        "customer_id": "c_custkey",
        "customer_unique_id": "case when c_custkey % 101 = 7 then null else 'u' || cast(c_custkey as varchar(20)) end",
        "customer_state": "'N' || cast(c_nationkey as varchar(20))",
        "customer_zip_code_prefix": "c_nationkey * 1000 + c_custkey % 1000",
        "customer_city": "c_mktsegment",
    },
)
RAW_SELLERS = Standin(
    "supplier",
    {
        "seller_id": "s_suppkey",
        "seller_zip_code_prefix": "s_nationkey * 1000 + s_suppkey % 1000",
        "seller_city": "s_name",
        "seller_state": "'N' || cast(s_nationkey as varchar(20))",
    },
)
RAW_LEADS = Standin(
    "supplier",
    {
        "mql_id": "case when s_suppkey % 41 = 40 then null else 'mql_' || cast(s_suppkey as varchar(20)) end",
        "first_contact_date": "date '1997-01-01' + cast(s_suppkey % 365 as int)",
        "landing_page_id": "'lp_' || cast(s_suppkey % 7 as varchar(20))",
        "origin": nth_sql("s_nationkey % 8", V.MARKETING_CHANNELS[1:3] + V.MARKETING_CHANNELS[4:8]),
    },
)
RAW_DEALS = Standin(
    "supplier",
    {
        # two thirds of the deals name no lead of the funnel
        "mql_id": "case when s_suppkey % 3 = 0 then 'mql_' else 'direct_' end || cast(s_suppkey as varchar(20))",
        "won_date": "case when s_suppkey % 33 = 30 then null else date '1997-03-01' + cast(s_suppkey % 300 as int) end",
        "seller_id": "s_suppkey",
        "sdr_id": "'sdr_' || cast(s_suppkey % 5 as varchar(20))",
        "sr_id": "'sr_' || cast(s_suppkey % 9 as varchar(20))",
        "business_segment": nth_sql("s_nationkey % 4", ["pet", "home_decor", "watches", "toys"]),
        "business_type": "case when s_suppkey % 2 = 0 then 'reseller' else 'manufacturer' end",
        "lead_type": nth_sql("s_suppkey % 3", ["online_big", "online_medium", "industry"]),
        "lead_behaviour_profile": nth_sql("s_nationkey % 5", ["cat", "eagle", "wolf", "shark"]),
        "has_company": "s_suppkey % 6 = 0",
        "has_gtin": "s_suppkey % 9 = 0",
        "average_stock": "'20-50'",
        "declared_product_catalog_size": "s_suppkey % 100",
        "declared_monthly_revenue": "s_acctbal",
    },
)
RAW_PRODUCTS = Standin(
    "part",
    {
        "product_id": "case when p_partkey % 113 = 9 then null else p_partkey end",
        "product_category_name": "p_type",
        "product_name_lenght": "length(p_name)",
        "product_description_lenght": "length(p_brand)",
        "product_photos_qty": "p_size % 6",
        "product_weight_g": "p_size * 100",
        "product_length_cm": "p_size",
        "product_height_cm": "p_size % 20",
        "product_width_cm": "p_size % 30",
    },
)
# distinct categories are taken by the caller
RAW_CATEGORIES = Standin(
    "part",
    # one category is listed under a name that no product has
    {"product_category_name": "case when p_type = 'PROMO' then 'OFFERS' else p_type end", "product_category_name_english": "lower(p_type)"},
)
RAW_GEOLOCATION = Standin(
    "supplier",
    {
        "geolocation_city": "s_name",
        "geolocation_lat": "cast(s_suppkey % 180 - 90 as double)",
        "geolocation_lng": "case when s_suppkey % 17 = 0 then null else cast(s_suppkey % 360 - 180 as double) end",
        "geolocation_state": "'N' || cast(s_nationkey as varchar(20))",
        "geolocation_zip_code_prefix": "s_nationkey",
    },
)

# --- customers -------------------------------------------------------------------

CUSTOMERS = Standin(
    "customer",
    {
        "customer_id": "c_custkey",
        "first_name": "c_name",
        "last_name": "c_mktsegment",
        "email": "lower(c_name) || '@example.com'",
    },
)
CUSTOMER_ORDERS = Standin(
    "orders",
    {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "order_date": "o_orderdate",
        "amount": "o_totalprice",
        "order_status": nth_sql("o_orderkey % 5", V.DAILY_STATUSES),
    },
)

# --- hotel -------------------------------------------------------------------------

_CANCELED = "l_returnflag = 'R'"
_WEEKEND, _WEEK = "cast(l_quantity as int) % 3", "cast(l_quantity as int) % 8"
BOOKINGS = Standin(
    "lineitem",
    {
        "hotel": "case when l_suppkey % 10 = 2 then 'Guest House' when l_suppkey % 3 = 0 then 'Resort Hotel' else 'City Hotel' end",
        "hotel_id": "'H' || cast(l_suppkey % 20 as varchar(20))",
        "hotel_name": "'Hotel ' || cast(l_suppkey % 20 as varchar(20)) || case when l_suppkey % 20 = 7 and l_linenumber % 2 = 0 then ' Annex' else '' end",
        "region": "'R' || cast(l_suppkey % 5 as varchar(20))",
        "is_canceled": f"case when {_CANCELED} then 1 else 0 end",
        "lead_time": "cast((l_orderkey * 7 + l_linenumber * 13) % 365 as int)",
        "arrival_date_year": "year(l_shipdate)",
        "arrival_date_month": "{month_name}",
        "arrival_date_week_number": "{week}",
        "arrival_date_day_of_month": "day(l_shipdate)",
        "stays_in_weekend_nights": _WEEKEND,
        "stays_in_week_nights": _WEEK,
        "adults": "l_linenumber % 3 + 1",
        "children": "case when l_linenumber % 4 = 0 then null else l_linenumber % 3 end",
        "babies": "case when l_orderkey % 11 = 0 then 1 else 0 end",
        "meal": nth_sql("l_partkey % 3", ["BB", "HB", "SC"]),
        "market_segment": nth_sql("l_partkey % 5", ["Online TA", "Offline TA/TO", "Groups", "Direct", "Corporate"]),
        "distribution_channel": nth_sql("l_partkey % 3", ["TA/TO", "Direct", "GDS"]),
        "is_repeated_guest": "case when l_orderkey % 4 = 0 then 1 else 0 end",
        "previous_cancellations": "case when l_orderkey % 6 = 0 then 1 else 0 end",
        "previous_bookings_not_canceled": "l_linenumber % 2",
        "reserved_room_type": "substr('ABCDEFGHLP', cast(l_partkey % 10 as int) + 1, 1)",
        "assigned_room_type": "substr('ABCDEFGHLP', cast(l_suppkey % 10 as int) + 1, 1)",
        "booking_changes": "l_linenumber % 4",
        "deposit_type": "case when l_partkey % 9 = 0 then null when l_linestatus = 'O' then 'No Deposit' else 'Non Refund' end",
        "agent": "l_suppkey",
        "company": "case when l_partkey % 5 = 4 then l_partkey % 50 end",
        "days_in_waiting_list": "cast(l_orderkey % 15 as int)",
        "customer_type": nth_sql("l_suppkey % 4", ["Transient", "Contract", "Group", "Transient-Party"]),
        "adr": "case when l_partkey % 97 = 0 then cast(0 as decimal(8,2)) when l_partkey % 89 = 0 then null "
        "else cast(cast(l_extendedprice as decimal(8,2)) * cast(0.01 as decimal(3,2)) as decimal(8,2)) end",
        "required_car_parking_spaces": "l_linenumber % 2",
        "total_of_special_requests": "l_linenumber % 5",
        "reservation_status": f"case when {_CANCELED} and l_orderkey % 5 <> 0 then 'Canceled' when {_CANCELED} then 'No-Show' else 'Check-Out' end",
        "reservation_status_date": f"case when l_partkey % 83 = 0 then null when {_CANCELED} then cast(l_shipdate as date) - cast(l_orderkey % 30 as int) "
        f"else cast(l_shipdate as date) + cast({_WEEKEND} + {_WEEK} as int) end",
    },
)

# --- spend ---------------------------------------------------------------------------

# written offsets: plain UTC, Z, and +05:30 (whose instant lies 5.5 hours earlier)
OFFSET_ROW = "event_id % 11 = 0"
_AMOUNT = (
    "case when event_id % 10 = 0 then cast(1000 * (event_id % 12) as decimal(18,2)) "
    "else cast(cast(value as decimal(18,2)) * 25 as decimal(18,2)) end"
)
_BASELINE = "case when user_id % 29 = 0 then 0 else 20000 + (user_id * 7919) % 13 * 15000 end"
_TIMESTAMP = "{iso_ts} || case when " + OFFSET_ROW + " then '+05:30' when event_id % 5 = 0 then 'Z' else '+00:00' end"
TRANSACTIONS = Standin(
    "events",
    {
        "transaction_id": "'tx_' || cast(event_id as varchar(20))",
        "company_id": "'company_' || lpad(cast(user_id as varchar(20)), 4, '0')",
        "company_name": "'Company ' || cast(user_id as varchar(20))",
        "company_size_tier": nth_sql("user_id % 3", ["smb", "mid_market", "enterprise"]),
        "vendor_id": "'vendor_' || lpad(cast({k} as varchar(20)), 4, '0')",
        "vendor_name": "'Vendor ' || cast({k} as varchar(20))",
        "vendor_category": nth_sql("{k} % 11", V.VENDOR_CATEGORIES + ["unlisted"]),
        "vendor_risk_tier": "case when {k} % 10 < 6 then 'low' when {k} % 10 < 9 then 'medium' else 'high' end",
        "amount_usd": f"cast({_AMOUNT} as double)",
        "currency": "'USD'",
        "payment_method": "event_type",
        "department": nth_sql("user_id % 6", ["IT", "HR", "Sales", "Finance", "Legal", "Operations"]),
        "timestamp": _TIMESTAMP,
        "baseline_monthly_spend": f"cast({_BASELINE} as double)",
        "is_anomaly": "case when event_type = 'signup' then null else event_type = 'error' end",
        "anomaly_type": "case when event_type = 'error' then 'spend_spike' end",
        "ml_raw_score": "case when event_id % 17 = 0 then null else cast((event_id * 37) % 70 - 60 as double) / 100 end",
        "event_id": "event_id",
        "ts": "ts",
    },
)
SCORED_EXTRA = ["event_id", "ts"]

_JSON = (
    "'{\"transaction_id\":\"tx_' || cast(event_id as varchar(20)) "
    "|| '\",\"company_id\":\"company_' || lpad(cast(user_id as varchar(20)), 4, '0') "
    "|| '\",\"company_name\":\"Company ' || cast(user_id as varchar(20)) "
    "|| '\",\"company_size_tier\":' || case when event_id % 50 = 9 then 'null' else '\"smb\"' end "
    "|| ',\"vendor_id\":\"vendor_' || lpad(cast({k} as varchar(20)), 4, '0') "
    "|| '\",\"vendor_category\":\"' || " + nth_sql("{k} % 11", V.VENDOR_CATEGORIES + ["unlisted"]) + " "
    "|| '\",\"vendor_risk_tier\":\"low\",\"amount_usd\":' "
    "|| case event_id % 50 when 2 then '\"abc\"' when 4 then 'null' when 6 then '\"12d\"' when 7 then 'true' "
    "when 8 then '[1]' when 5 then '\"' || cast(" + _AMOUNT + " as varchar(20)) || '\"' "
    "else cast(" + _AMOUNT + " as varchar(20)) end "
    "|| ',\"timestamp\":\"' || " + _TIMESTAMP + " || '\"' "
    "|| case when event_id % 50 in (0, 10) then '' else ',\"baseline_monthly_spend\":' || cast(" + _BASELINE + " as varchar(20)) end "
    "|| case event_id % 50 when 1 then '' when 3 then '} trailing' when 11 then '}]' when 12 then '},{\"a\":1}' else '}' end"
)
MESSAGES = Standin(
    "events",
    {
        "value": f"case event_id % 50 when 13 then '' when 14 then '[1, 2]' else {_JSON} end",
        "arrived_at": "ts",
        "event_id": "event_id",
    },
)

# --- shop -------------------------------------------------------------------------------

_EVENT_TYPE = (
    "case event_type when 'view' then 'page_view' when 'purchase' then 'purchase' when 'click' then 'add_to_cart' "
    "when 'signup' then 'checkout_started' else 'error' end"
)
_AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0) Safari/604.1",
    "Mozilla/5.0 (iPad; CPU OS 16_0) Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120 Safari/537.36 Edg/120",
    "Mozilla/5.0 (X11; Linux) Chrome/119 Safari/537.36 OPR/105",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.1; Trident/4.0)",
    "Opera/9.80 (Windows NT 6.1) Presto/2.12",
    "Mozilla/5.0 (X11; Linux) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPad; CPU OS 15_0) FxiOS/118",
    "curl/8.4.0",
    "Mozilla/5.0 (Tablet; rv:68.0) Gecko/68.0",
    "",
]
SHOP_EVENTS = Standin(
    "events",
    {
        "event_id": "event_id",
        "type": _EVENT_TYPE,
        "user_id": "'usr_' || cast(user_id as varchar(20))",
        "session_id": "'s_' || cast(user_id as varchar(20)) || '_' || cast(day(ts) as varchar(20))",
        "product_id": "case when event_id % 13 = 0 then null else 'SKU-' || cast({k} as varchar(20)) end",
        "timestamp": "{iso_ts} || '+00:00'",
        "user_agent": nth_sql("event_id % 11", _AGENTS),
        "ip_number": "(user_id % 250) * 16777216 + ({k} * 65536) + (event_id % 65536)",
        "ts": "ts",
        "value": "cast(value as decimal(18,2))",
    },
)
_IP = (
    "cast(user_id % 250 as varchar(20)) || '.' || cast({k} as varchar(20)) || '.' "
    "|| cast(event_id % 256 as varchar(20)) || '.1'"
)
TOPIC_EVENTS = Standin(
    "events",
    {
        "topic": "case when event_id % 60 = 59 then 'clicks' else 'events' end",
        "value": "case event_id % 60 when 1 then 'not json' when 2 then '[]' else "
        "'{\"type\":' || case event_id % 60 when 3 then '\"\"' when 4 then 'null' else '\"' || " + _EVENT_TYPE + " || '\"' end "
        "|| case when event_id % 60 = 5 then '' else ',\"user_id\":\"usr_' || cast(user_id as varchar(20)) || '\"' end "
        "|| ',\"session_id\":' || case event_id % 60 when 6 then '0' when 7 then '[]' else '\"s_' || cast(user_id as varchar(20)) || '\"' end "
        "|| ',\"product_id\":\"SKU-' || cast({k} as varchar(20)) "
        "|| '\",\"timestamp\":\"' || case event_id % 60 when 8 then 'yesterday' when 9 then '2024-13-01T00:00:00' else {iso_ts} end "
        "|| '\",\"metadata\":{\"ip\":\"' || " + _IP + " || '\",\"user_agent\":\"' || " + nth_sql("event_id % 11", _AGENTS) + " || '\"}}' end",
        "offset": "event_id",
        "timestamp": "ts",
        "event_id": "event_id",
    },
)
_DOC_STATUS = nth_sql("o_orderkey % 6", V.DOC_ORDER_STATUSES)
TOPIC_ORDERS = Standin(
    "orders",
    {
        "topic": "'orders'",
        "value": "'{\"order_id\":\"ORD-' || cast(cast(floor(o_orderkey / 2) as bigint) as varchar(20)) "
        "|| '\",\"user_id\":\"usr_' || cast(o_custkey as varchar(20)) || '\",\"items\":' "
        "|| case o_orderkey % 40 when 1 then '[]' when 3 then '\"none\"' else "
        "'[{\"product_id\":\"SKU-' || cast(o_orderkey % 100 as varchar(20)) || '\",\"unit_price\":10.5,\"quantity\":2}]' end "
        "|| ',\"totals\":{\"subtotal\":21.0' || case o_orderkey % 40 when 5 then '' when 7 then ',\"total\":-1' "
        "else ',\"total\":' || cast(cast(o_totalprice as decimal(18,2)) as varchar(20)) end "
        "|| '},\"status\":\"' || case when o_orderkey % 40 = 9 then 'lost' else " + _DOC_STATUS + " end "
        "|| '\"' || case when o_orderkey % 2 = 1 then '' else ',\"shipping_address\":{\"city\":\"' || o_orderpriority || '\"}' end "
        "|| ',\"created_at\":\"2024-01-01T00:00:00\"}'",
        "offset": "o_orderkey",
        "timestamp": "o_orderdate",
        "o_orderkey": "o_orderkey",
    },
)
# integer address ranges per nation; 250 leading octets, ten to a nation
GEO_RANGES = Standin(
    "nation",
    {
        "range_start": "cast(n_nationkey as bigint) * 10 * 16777216",
        "range_end": "cast(n_nationkey as bigint) * 10 * 16777216 + 9 * 16777216 - 1",
        "country": "n_name",
        "country_code": "'N' || cast(n_nationkey as varchar(20))",
        "city": "'City ' || cast(n_regionkey as varchar(20))",
    },
)

# networks of two families (0: four octets, 1: eight groups) that overlap and lie in one another
NETWORKS = [
    Standin(
        "nation",
        {
            "family": "n_nationkey % 2",
            "low": "cast(n_nationkey as bigint) * 10 * 16777216",
            "high": "cast(n_nationkey as bigint) * 10 * 16777216 + 90 * 16777216 - 1",
            "name": "n_name",
        },
    ),
    Standin(
        "supplier",
        {
            "family": "s_suppkey % 2",
            "low": "cast(s_suppkey * 7919 % 250 as bigint) * 16777216",
            "high": "cast(s_suppkey * 7919 % 250 as bigint) * 16777216 + (s_suppkey % 7 + 1) * 4000000",
            "name": "'s' || cast(s_suppkey as varchar(20))",
        },
    ),
    Standin(
        "customer",
        {
            "family": "c_custkey % 2",
            "low": "cast(c_custkey * 7919 % 250 as bigint) * 16777216 + (c_custkey % 200) * 65536",
            "high": "cast(c_custkey * 7919 % 250 as bigint) * 16777216 + (c_custkey % 200 + c_custkey % 5 + 1) * 65536 - 1",
            "name": "'c' || cast(c_custkey as varchar(20))",
        },
    ),
]

# --- bank ---------------------------------------------------------------------------------

_CURRENCY = "case when {key} % 5 = 4 then 'GBP' when {key} % 2 = 0 then 'USD' else 'EUR' end"
ACCOUNTS_C = Standin(
    "customer",
    {
        "account_id": "'AC' || cast(c_custkey as varchar(20))",
        "account_no": "c_custkey",
        "currency": _CURRENCY.replace("{key}", "c_nationkey"),
        "current_balance": "cast(cast(c_acctbal as decimal(18,2)) * 20 as decimal(28,6))",
        "minimum_balance": "cast(100 as decimal(28,6))",
        "account_category": "'Customer'",
    },
)
ACCOUNTS_M = Standin(
    "supplier",
    {
        "account_id": "'MA' || cast(s_suppkey as varchar(20))",
        "account_no": "s_suppkey",
        "currency": _CURRENCY.replace("{key}", "s_nationkey"),
        "current_balance": "cast(cast(s_acctbal as decimal(18,2)) as decimal(28,6))",
        "minimum_balance": "cast(0 as decimal(28,6))",
        "account_category": "'Merchant'",
    },
)
REQUESTS = Standin(
    "orders",
    {
        "seq": "o_orderkey",
        "transaction_type": nth_sql("o_orderkey % 9", V.LEDGER_TYPES + ["charge"]),
        "primary_account_id": "'AC' || cast(case when o_orderkey % 101 = 0 then -1 else o_custkey end as varchar(20))",
        "secondary_account_id": "'AC' || cast(o_custkey + 1 as varchar(20))",
        "merchant_account_id": "'MA' || cast(o_orderkey % 10 as varchar(20))",
        "amount": "cast(cast(o_totalprice as decimal(18,2)) * cast(0.1 as decimal(2,1)) as decimal(18,2))",
        "charge": "cast(50 + o_orderkey % 51 as decimal(18,2)) * cast(0.01 as decimal(3,2))",
        "timestamp": "o_orderdate",
    },
)

# --- university -----------------------------------------------------------------------

# two departments of each college, with engineering among them, and one that no college lists
DEPARTMENTS = [
    "Biology", "Mechanical Engineering", "History", "English", "Finance", "Marketing", "Law", "Nursing", "Alchemy",
]
_DEPARTMENT_OF = [
    next((c for c, names in V.COLLEGE_DEPARTMENTS.items() if d in names), V.UNKNOWN_COLLEGE) for d in DEPARTMENTS
]
STUDENTS = Standin(
    "customer",
    {
        "student_id": "'S' || cast(c_custkey as varchar(20))",
        "student_no": "c_custkey",
        "email": "lower(c_name) || '@example.com'",
        "first_name": "'F' || cast(c_custkey % 50 as varchar(20))",
        "last_name": "'L' || cast(c_custkey % 37 as varchar(20))",
        "gender": nth_sql("c_custkey % 4", ["Male", "Female", "Transgender", "Non-Binary"]),
        "country": "case when c_custkey % 7 = 0 then null when c_nationkey % 3 = 0 then 'United States' else 'NATION_' || cast(c_nationkey as varchar(20)) end",
        "race": nth_sql("c_custkey % 5", ["White", "Black", "Asian", "white"]),
        "department": nth_sql("c_custkey % 9", DEPARTMENTS),
        "college": nth_sql("c_custkey % 9", _DEPARTMENT_OF),
        "campus": "'Campus ' || cast(c_nationkey % 4 as varchar(20))",
        "enrollment_year": "2020 + cast(c_nationkey % 6 as int)",
        "award": "case when c_custkey % 23 = 0 then 'Merit Award' end",
        "scholarship": "case when c_custkey % 17 = 0 then 'Travel Grant' when c_custkey % 19 = 0 then 'Lapsed Grant' end",
        "housing": "case c_custkey % 8 when 0 then 'Pending' when 1 then 'External Housing' else 'R' || cast(c_custkey % 10 as varchar(20)) end",
    },
)
COURSES = Standin(
    "part",
    {
        "course_code": "'C' || cast(p_partkey as varchar(20))",
        "course_no": "p_partkey",
        "title": "p_name || ' ' || cast(p_partkey as varchar(20))",
        "department": nth_sql("p_partkey % 9", DEPARTMENTS),
        "credits": "p_size % 5",
        "type": "case when p_partkey % 18 < 9 then 'Compulsory' else 'Elective' end",
        "year": "cast(p_partkey % 3 as int) + 1",
        "semester": "p_size % 2 + 1",
    },
)
TRANSCRIPT = Standin(
    "lineitem",
    {
        "student_id": "'S' || cast(cast(floor(l_orderkey / 10) as bigint) as varchar(20))",
        "course": "'C' || cast(l_partkey as varchar(20))",
        # every fifth student is strong, so that grade means reach the award limits
        "mark": "least(100.0, l_quantity + 25 + cast(floor(l_orderkey / 10) as bigint) % 5 * cast(12.5 as double))",
        "kind": "case when l_linenumber >= 6 then 'elective' else 'course' end",
        "pos": "l_linenumber",
    },
)
ROOMS = Standin(
    "supplier",
    {
        "room_id": "'R' || cast(s_suppkey as varchar(20))",
        "room_no": "s_suppkey",
        "campus": "'Campus ' || cast(s_suppkey % 4 as varchar(20))",
        "type": nth_sql("cast(floor(s_suppkey / 4) as bigint) % 6", V.HOUSING_TYPES),
        "capacity": "cast(s_nationkey % 5 as int)",
        "rent": "500 + s_suppkey % 90 * 10",
        "status": nth_sql("s_suppkey % 3", V.ROOM_STATUSES),
    },
)
EMPLOYEES = Standin(
    "supplier",
    {
        "employee_id": "'E' || cast(s_suppkey as varchar(20))",
        "employee_no": "s_suppkey",
        "first_name": "s_name",
        "last_name": "'N' || cast(s_nationkey as varchar(20))",
        "department": nth_sql("s_suppkey % 9", DEPARTMENTS),
        "position": nth_sql("s_suppkey % 5", V.FACULTY_POSITIONS + [V.HEAD_POSITION]),
        "campus": "'Campus ' || cast(s_suppkey % 4 as varchar(20))",
    },
)
