"""Registered data-quality queries: the suites of the marts and the stored-document schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators import quality as Q
from ..plans import velocity
from . import bank, customers, marketplace, shop, spend
from . import standins as S
from .common import Catalog, big, moment, plain, quoted, rounded

catalog = Catalog()

COLUMNS = '"table", "check", "column", observed, unexpected, success'


def _row(table: str, check: str, column: str, observed: str, unexpected: str, success: str) -> str:
    return (
        f"select '{table}' \"table\", '{check}' \"check\", '{column}' \"column\", "
        f"{rounded(observed, 6)} observed, {big(unexpected)} unexpected, {success} success from t"
    )


def _rowwise(table: str, check: str, column: str, good: str, counted: str = "true", mostly: float = 1.0) -> str:
    fine = f"count(*) filter (({counted}) and coalesce({good}, false))"
    rows = f"count(*) filter ({counted})"
    share = f"coalesce({fine} / nullif({rows}, 0), 1.0)"
    return _row(table, check, column, share, f"{rows} - {fine}", f"{share} >= {mostly}")


def _suite_sql(source: str, rows: list[str]) -> str:
    return f"with t as (select * from {source}) " + " union all ".join(rows)


# --- marketplace facts ------------------------------------------------------------------------

MONEY = [("total_items_price", 50000), ("total_freight_value", 5000), ("total_order_item_value", 55000)]
PAIRS = [("delivered_customer_date", "purchase_date", 1.0), ("delivered_carrier_date", "approved_date", 0.99)]
STATUSES = [V.DELIVERY_OPEN, V.DELIVERY_ON_TIME, V.DELIVERY_LATE]


def order_checks() -> list[Q.Check]:
    return [
        Q.not_null("order_id"),
        Q.not_null("purchase_date"),
        Q.accepted_values("delivery_performance_status", STATUSES),
        Q.row_count_between(1000, 500_000),
        Q.accepted_values("order_status", V.ORDER_STATUSES),
        *[Q.between(c, 0, high) for c, high in MONEY],
        *[Q.pair_at_least(a, b, mostly=m) for a, b, m in PAIRS],
        Q.mean_between("total_order_item_value", 50, 400),
    ]


_FACTS_SQL = f"({marketplace.catalog.checks['fct_orders']})"


@catalog.add(
    "quality_fct_orders",
    _suite_sql(
        _FACTS_SQL,
        [
            _rowwise("fct_orders", "not_null", "order_id", "order_id is not null"),
            _rowwise("fct_orders", "not_null", "purchase_date", "purchase_date is not null"),
            _rowwise(
                "fct_orders", "accepted_values", "delivery_performance_status",
                f"delivery_performance_status in ({quoted(STATUSES)})", "delivery_performance_status is not null",
            ),
            _row("fct_orders", "row_count_between", "", "count(*)", "0", "count(*) between 1000 and 500000"),
            _rowwise("fct_orders", "accepted_values", "order_status", f"order_status in ({quoted(V.ORDER_STATUSES)})", "order_status is not null"),
            *[_rowwise("fct_orders", "between", c, f"{c} between 0 and {high}", f"{c} is not null") for c, high in MONEY],
            *[
                _rowwise("fct_orders", "pair_at_least", f"{a},{b}", f"{a} >= {b}", f"{a} is not null and {b} is not null", m)
                for a, b, m in PAIRS
            ],
            _row(
                "fct_orders", "mean_between", "total_order_item_value",
                "avg(cast(total_order_item_value as decimal(18,2)))", "0", "avg(total_order_item_value) between 50 and 400",
            ),
            "select 'fct_orders', 'unique', 'order_id', cast(count(*) as double), count(*), count(*) = 0 "
            "from (select order_id from t where order_id is not null group by order_id having count(*) > 1)",
        ],
    ),
)
def _(spark, folder):
    facts = marketplace.facts(spark, folder)
    results = [Q.run_rowwise("fct_orders", facts, order_checks()), Q.run_unique("fct_orders", facts, "order_id")]
    return plain(Q.union_results(results))


@catalog.add(
    "quality_dim_sellers",
    _suite_sql(
        f"({marketplace.catalog.checks['dim_sellers']})",
        [
            _row("dim_sellers", "row_count_between", "", "count(*)", "0", "count(*) between 100 and 20000"),
            _rowwise("dim_sellers", "accepted_values", "is_funnel_acquired", "is_funnel_acquired in (true, false)", "is_funnel_acquired is not null"),
            _rowwise(
                "dim_sellers", "accepted_values", "marketing_channel", f"marketing_channel in ({quoted(V.MARKETING_CHANNELS)})",
                "marketing_channel is not null", 0.99,
            ),
            _row(
                "dim_sellers", "unique_proportion_between", "seller_id",
                "count(distinct seller_id) / count(seller_id)", "0", "count(distinct seller_id) = count(seller_id)",
            ),
        ],
    ),
)
def _(spark, folder):
    sellers = marketplace.sellers(spark, folder)
    checks = [
        Q.row_count_between(100, 20_000),
        Q.accepted_values("is_funnel_acquired", [True, False]),
        Q.accepted_values("marketing_channel", V.MARKETING_CHANNELS, mostly=0.99),
    ]
    results = [
        Q.run_rowwise("dim_sellers", sellers, checks),
        Q.run_unique_proportion("dim_sellers", sellers, "seller_id", 1.0, 1.0),
    ]
    return plain(Q.union_results(results))


@catalog.add(
    "quality_attribution",
    _suite_sql(
        f"({marketplace.catalog.checks['b2b2c_attribution']})",
        [
            _row("attribution", "row_count_between", "", "count(*)", "0", "count(*) between 1000 and 600000"),
            _rowwise("attribution", "between", "attributed_revenue", "attributed_revenue between 0 and 50000", "attributed_revenue is not null"),
            _rowwise("attribution", "between", "attributed_freight", "attributed_freight between 0 and 5000", "attributed_freight is not null"),
            _rowwise(
                "attribution", "pair_at_least", "attributed_total_value,attributed_revenue",
                "attributed_total_value >= attributed_revenue", "attributed_total_value is not null and attributed_revenue is not null",
            ),
            _rowwise("attribution", "not_null", "seller_id", "seller_id is not null"),
        ],
    ),
)
def _(spark, folder):
    checks = [
        Q.row_count_between(1000, 600_000),
        Q.between("attributed_revenue", 0, 50_000),
        Q.between("attributed_freight", 0, 5_000),
        Q.pair_at_least("attributed_total_value", "attributed_revenue"),
        Q.not_null("seller_id"),
    ]
    return plain(Q.run_rowwise("attribution", marketplace.attribution(spark, folder), checks))


# --- customers --------------------------------------------------------------------------------


@catalog.add(
    "quality_customers",
    _suite_sql(
        S.CUSTOMERS.sql,
        [
            _rowwise("customers", "not_null", "customer_id", "customer_id is not null"),
            _rowwise("customers", "not_null_proportion", "customer_id", "customer_id is not null", mostly=0.99),
            "select 'customers', 'unique', 'customer_id', cast(count(*) as double), count(*), count(*) = 0 from (select customer_id from t group by 1 having count(*) > 1)",
            f"""select 'orders', 'relationship', 'customer_id', cast(count(*) as double), count(*), count(*) = 0
            from {S.CUSTOMER_ORDERS.sql} where customer_id + (order_id % 50 = 0)::int * 100000000 not in (select customer_id from t)""",
            f"""select 'customer_has_orders', 'singular', '', cast(count(*) as double), count(*), count(*) = 0
            from t where customer_id not in (select customer_id from {S.CUSTOMER_ORDERS.sql})""",
        ],
    ),
)
def _(spark, folder):
    people = customers.customers(spark, folder)
    orders = S.CUSTOMER_ORDERS.frame(spark, folder)
    strayed = orders.withColumn(
        "customer_id", F.col("customer_id") + F.when(F.col("order_id") % 50 == 0, 100_000_000).otherwise(0)
    )
    all_orders = customers.C.stage_orders(S.CUSTOMER_ORDERS.frame(spark, folder))
    results = [
        Q.run_rowwise("customers", people, [Q.not_null("customer_id"), Q.not_null_proportion("customer_id", 0.99)]),
        Q.run_unique("customers", people, "customer_id"),
        Q.run_relationship("orders", strayed, "customer_id", people, "customer_id"),
        Q.run_singular("customer_has_orders", customers.C.customers_without_orders(people, all_orders)),
    ]
    return plain(Q.union_results(results))


# --- spend marts ------------------------------------------------------------------------------

TIERS = ["low", "medium", "high"]
SIZES = ["smb", "mid_market", "enterprise"]
FILLED = ["transaction_id", "company_id", "vendor_id", "transacted_at", "amount_usd", "risk_tier", "final_risk_score", "risk_flag"]


@catalog.add(
    "quality_spend",
    _suite_sql(
        f"({spend.catalog.checks['fct_transactions']})",
        [
            *[_rowwise("fct_transactions", "not_null", c, f"{c} is not null") for c in FILLED],
            *[
                _rowwise("fct_transactions", "accepted_values", c, f"{c} in ({quoted(values)})", f"{c} is not null")
                for c, values in [("risk_tier", TIERS), ("vendor_risk_tier", TIERS), ("company_size_tier", SIZES)]
            ],
            "select 'fct_transactions', 'unique', 'transaction_id', cast(count(*) as double), count(*), count(*) = 0 from (select transaction_id from t group by 1 having count(*) > 1)",
        ],
    ),
)
def _(spark, folder):
    facts = spend.facts(spark, folder)
    checks = [
        *[Q.not_null(c) for c in FILLED],
        Q.accepted_values("risk_tier", TIERS),
        Q.accepted_values("vendor_risk_tier", TIERS),
        Q.accepted_values("company_size_tier", SIZES),
    ]
    results = [Q.run_rowwise("fct_transactions", facts, checks), Q.run_unique("fct_transactions", facts, "transaction_id")]
    return plain(Q.union_results(results))


# --- stored documents of the bank and the shop ---------------------------------------------------

_STORED = f"({bank.catalog.checks['transaction_ids']})"
_REQUIRED = ["transaction_id", "sender_account_id", "receiver_account_id", "amount", "transaction_type", "timestamp", "status", "currency"]


@catalog.add(
    "schema_violations",
    _suite_sql(
        _STORED,
        [
            *[_rowwise("transactions", "required", c, f'"{c}" is not null') for c in _REQUIRED],
            _rowwise("transactions", "type_int", "transaction_id", "try_cast(transaction_id as int) is not null", "transaction_id is not null"),
            _rowwise("transactions", "type_double", "amount", "true", "amount is not null"),
            _rowwise("transactions", "minimum", "amount", "amount >= 0", "amount is not null"),
            _rowwise("transactions", "accepted_values", "transaction_type", f"transaction_type in ({quoted(V.STORED_TRANSACTION_TYPES)})", "transaction_type is not null"),
            _rowwise("transactions", "accepted_values", "status", f"status in ({quoted(V.TRANSACTION_STATUSES)})", "status is not null"),
        ],
    ),
)
def _(spark, folder):
    """Stored rows against the document schema; their ids are text, which its integer type refuses."""
    stored = bank.K.stored_rows(bank.posted(spark, folder), last_number=500)
    checks = [
        *[Q.required(c) for c in _REQUIRED],
        Q.has_type("transaction_id", "int"),
        Q.has_type("amount", "double"),
        Q.minimum("amount", 0),
        Q.accepted_values("transaction_type", V.STORED_TRANSACTION_TYPES),
        Q.accepted_values("status", V.TRANSACTION_STATUSES),
    ]
    return plain(Q.run_rowwise("transactions", stored, checks))


@catalog.add(
    "account_violations",
    _suite_sql(
        bank._ACCOUNTS_SQL,
        [
            _rowwise("accounts", "minimum", "current_balance", "current_balance >= 0", "current_balance is not null"),
            _rowwise("accounts", "minimum", "minimum_balance", "minimum_balance >= 0", "minimum_balance is not null"),
            _rowwise("accounts", "required", "account_id", "account_id is not null"),
            _rowwise("accounts", "required", "currency", "currency is not null"),
        ],
    ),
)
def _(spark, folder):
    checks = [Q.minimum("current_balance", 0), Q.minimum("minimum_balance", 0), Q.required("account_id"), Q.required("currency")]
    return plain(Q.run_rowwise("accounts", bank.accounts(spark, folder), checks))


@catalog.add(
    "event_value_sets",
    _suite_sql(
        S.SHOP_EVENTS.sql,
        [
            _rowwise("events", "accepted_values", "type", f"type in ({quoted(V.EVENT_TYPES)})", "type is not null", 0.9),
            _rowwise("events", "inventory", "value", "value >= 0"),
        ],
    ),
)
def _(spark, folder):
    checks = [Q.accepted_values("type", V.EVENT_TYPES, mostly=0.9), Q.holds("inventory", "value", F.col("value") >= 0)]
    return plain(Q.run_rowwise("events", shop.events(spark, folder), checks))


# --- reconciliation and freshness -------------------------------------------------------------------


@catalog.add(
    "reconciliation",
    """select cast(o_orderdate as date)::varchar order_date, count(*) filter (o_orderkey % 5 = 0) left_value,
    nullif(count(*) filter (o_orderkey % 5 = 0 and o_orderkey % 400 <> 0), 0) right_value from orders group by o_orderdate
    having count(*) filter (o_orderkey % 5 = 0) > 0 and count(*) filter (o_orderkey % 400 = 0) > 0""",
)
def _(spark, folder):
    """Completed orders per day in the facts against a summary in which some are missing."""
    facts = customers.orders(spark, folder).filter(F.col("order_status") == "completed")
    per_day = facts.groupBy("order_date").agg(F.count(F.lit(1)).alias("completed"))
    short = facts.filter(F.col("order_id") % 400 != 0).groupBy("order_date").agg(F.count(F.lit(1)).alias("completed"))
    return plain(velocity.reconcile(per_day, short, "order_date", "completed"))


@catalog.add(
    "source_freshness",
    f"""select 'events' "table", {moment('max(ts)')} newest, {rounded("date_diff('microsecond', max(ts), timestamp '2024-01-31 12:00:00') / 3600000000.0", 4)} age_hours,
    max(ts) >= timestamp '2024-01-30 12:00:00' fresh from events""",
)
def _(spark, folder):
    rows = shop.events(spark, folder)
    return plain(velocity.freshness(rows, "events", "ts", "2024-01-31 12:00:00", 24))
