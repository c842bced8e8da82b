"""Registered customer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..plans import customers as C
from . import standins as S
from .common import Catalog, day, dbl, plain

catalog = Catalog()

_ORDERS_SQL = f"""(select order_id, customer_id, cast(order_date as date) order_date,
  cast(amount as decimal(10,2)) order_amount, order_status from {S.CUSTOMER_ORDERS.sql})"""


def orders(spark, folder):
    return C.stage_orders(S.CUSTOMER_ORDERS.frame(spark, folder))


def customers(spark, folder):
    return C.stage_customers(S.CUSTOMERS.frame(spark, folder))


@catalog.add(
    "staged_customer_orders",
    f"select order_id, customer_id, {day('order_date')} order_date, {dbl('order_amount')} order_amount, order_status from {_ORDERS_SQL}",
)
def _(spark, folder):
    return plain(orders(spark, folder))


@catalog.add("staged_customers", f"select * from {S.CUSTOMERS.sql}")
def _(spark, folder):
    return plain(customers(spark, folder))


def _spend_sql(kind: str) -> str:
    return f"""select c.customer_id, first_name, last_name, email, n total_orders,
    '$' || cast(round(cast(spend as {kind}), 2) as varchar) total_spend_formatted
    from {S.CUSTOMERS.sql} c left join
    (select customer_id, count(*) n, sum(amount) spend from (select customer_id, cast(amount as decimal(10,2)) amount
     from {S.CUSTOMER_ORDERS.sql}) group by customer_id) o on o.customer_id = c.customer_id"""


@catalog.add("customer_spend", _spend_sql("decimal(38,0)"))
def _(spark, folder):
    all_orders = orders(spark, folder)
    return plain(C.customer_spend(customers(spark, folder), all_orders))


@catalog.add("customer_spend_cents", _spend_sql("decimal(30,2)"))
def _(spark, folder):
    all_orders = orders(spark, folder)
    return plain(C.customer_spend(customers(spark, folder), all_orders, scale=2))


_COUNTS_SQL = ", ".join(f"count(*) filter (order_status = '{s}') total_{s}_orders" for s in V.DAILY_STATUSES)


def _sales_sql(status: str) -> str:
    return f"coalesce({dbl(f'''sum(order_amount) filter (order_status = '{status}')''')}, 0)"


@catalog.add(
    "daily_sales_summary",
    f"""select {day('order_date')} order_date, count(distinct order_id) total_orders, {_COUNTS_SQL},
    {_sales_sql('completed')} total_completed_sales, {_sales_sql('returned')} total_returned_sales,
    {dbl('''sum(case order_status when 'completed' then order_amount when 'returned' then -order_amount else 0 end)''')} total_net_sales
    from {_ORDERS_SQL} group by order_date""",
)
def _(spark, folder):
    return plain(C.daily_sales(orders(spark, folder)))


@catalog.add(
    "customers_without_orders",
    f"""select customer_id from {S.CUSTOMERS.sql}
    where customer_id not in (select customer_id from {S.CUSTOMER_ORDERS.sql})""",
)
def _(spark, folder):
    all_orders = orders(spark, folder)
    return plain(C.customers_without_orders(customers(spark, folder), all_orders))


MARK = "1999-06-30"


@catalog.add(
    "incremental_orders",
    f"""select order_id, customer_id, {day('order_date')} order_date, {dbl('order_amount')} order_amount, order_status
    from {_ORDERS_SQL} where order_date > (select max(order_date) from {_ORDERS_SQL} where order_date <= date '{MARK}')""",
)
def _(spark, folder):
    """What an incremental run takes when everything up to a date is stored."""
    raw = S.CUSTOMER_ORDERS.frame(spark, folder)
    stored = C.stage_orders(raw.filter(F.col("order_date") <= F.lit(MARK).cast("timestamp")))
    return plain(C.newer_orders(raw, stored))
