"""Registered ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.funds import accept_in_order
from ..plans import bank as K
from . import standins as S
from .common import Catalog, dbl, moment, plain, quoted

catalog = Catalog()


def accounts(spark, folder):
    return S.ACCOUNTS_C.frame(spark, folder).unionByName(S.ACCOUNTS_M.frame(spark, folder))


def requests(spark, folder):
    return S.REQUESTS.frame(spark, folder)


def rates(spark):
    return spark.createDataFrame(V.EXCHANGE_RATES, "currency_pair string, exchange_rate string")


def posted(spark, folder):
    return K.post(requests(spark, folder), accounts(spark, folder), rates(spark))


_RATES_SQL = "(values " + ", ".join(f"('{p}', cast({r} as decimal(12,6)))" for p, r in V.EXCHANGE_RATES) + ") q(pair, rate)"
_ACCOUNTS_SQL = f"(select * from {S.ACCOUNTS_C.sql} union all select * from {S.ACCOUNTS_M.sql})"
_SHOP = quoted(V.MERCHANT_TYPES)
_PREPARED_SQL = f"""(select *, case when transaction_type in ({_SHOP}) then amount * rate else amount end pay,
  case when transaction_type in ({_SHOP}) then amount else amount * rate end gain
  from (select r.seq, r.transaction_type, r."timestamp", r.amount, if(transaction_type = 'deposit', 0, r.charge) charge,
    payer, payee, p.currency payer_currency, e.currency payee_currency, p.current_balance payer_balance,
    p.minimum_balance payer_minimum,
    case when payer is null or payee is null or p.currency = e.currency then 1 else (select rate from {_RATES_SQL}
      where pair = if(transaction_type in ({_SHOP}), e.currency || '/' || p.currency, p.currency || '/' || e.currency)) end rate
    from (select *, case when transaction_type in ('withdrawal', 'transfer', {_SHOP}) then primary_account_id
        when transaction_type in ('cheque deposit', 'cheque withdrawal') then secondary_account_id end payer,
      case when transaction_type in ('deposit', 'cheque deposit') then primary_account_id
        when transaction_type in ({_SHOP}) then merchant_account_id
        when transaction_type = 'transfer' then secondary_account_id end payee
      from {S.REQUESTS.sql} where transaction_type <> 'charge') r
    left join {_ACCOUNTS_SQL} p on p.account_id = payer left join {_ACCOUNTS_SQL} e on e.account_id = payee
    where (payer is null or p.account_id is not null) and (payee is null or e.account_id is not null))
  where transaction_type not in ({_SHOP}) or rate is not null)"""
def _posted_sql(covered: str) -> str:
    return f"""(select *, case when transaction_type in ({_SHOP}) then pay when transaction_type = 'transfer' and funded then gain
    else amount end stored_amount
  from (select *, payer is null or {covered} funded from {_PREPARED_SQL})
  where not funded or rate is not null)"""


_POSTED_SQL = _posted_sql("payer_balance - pay - charge >= payer_minimum")
_ROW_SQL = f"""transaction_type, {dbl('cast(stored_amount as decimal(18,4))')} amount, {dbl('charge')} charge,
  if(transaction_type = 'deposit' or (transaction_type = 'transfer' and funded), payee_currency, payer_currency) currency,
  coalesce(payer, '{V.EXTERNAL_PARTY}') sender_account_id,
  if(transaction_type = 'withdrawal', '{V.NO_PARTY}', coalesce(payee, '{V.EXTERNAL_PARTY}')) receiver_account_id,
  {moment('"timestamp"')} "timestamp", if(funded, 'success', 'failed') status,
  if(funded, null, '{V.FAIL_REASON}') reason"""


@catalog.add("ledger_post", f"select seq, {_ROW_SQL} from {_POSTED_SQL}")
def _(spark, folder):
    return plain(posted(spark, folder).drop(*K.BOOKING_DETAIL))


@catalog.add(
    "transaction_ids",
    f"""select 'TX' || lpad((500 + row_number() over (order by seq))::varchar, 9, '0') transaction_id, {_ROW_SQL} from {_POSTED_SQL}""",
)
def _(spark, folder):
    return plain(K.stored_rows(posted(spark, folder), last_number=500))


_LEGS_SQL = f"""(select seq, payer account_id, -(pay + charge) signed from {_POSTED_SQL} where funded and payer is not null
  union all select seq, payee, gain from {_POSTED_SQL} where funded and payee is not null)"""


@catalog.add("ledger_legs", f"select seq, account_id, {dbl('cast(signed as decimal(18,4))')} signed_amount from {_LEGS_SQL}")
def _(spark, folder):
    return plain(K.legs(posted(spark, folder)))


@catalog.add(
    "ledger_balances",
    f"""select a.account_id, currency, {dbl('cast(current_balance as decimal(18,4))')} current_balance,
    {dbl('cast(coalesce(net, 0) as decimal(18,4))')} net_change,
    {dbl('cast(current_balance + coalesce(net, 0) as decimal(18,4))')} new_balance
    from {_ACCOUNTS_SQL} a left join (select account_id, sum(signed) net from {_LEGS_SQL} group by account_id) l
    on l.account_id = a.account_id""",
)
def _(spark, folder):
    return plain(K.balances(accounts(spark, folder), K.legs(posted(spark, folder))))


@catalog.add(
    "running_balances",
    f"""select l.account_id, seq, {dbl('cast(signed as decimal(18,4))')} signed_amount,
    {dbl('cast(current_balance + sum(signed) over (partition by l.account_id order by seq) as decimal(18,4))')} balance_after
    from {_LEGS_SQL} l join {_ACCOUNTS_SQL} a on a.account_id = l.account_id""",
)
def _(spark, folder):
    return plain(K.running_balances(accounts(spark, folder), K.legs(posted(spark, folder))))


@catalog.add(
    "ledger_post_in_order",
    f"""with recursive debits as (select payer, seq, cast((pay + charge) * 1000000 as bigint) debit,
      cast((payer_balance - payer_minimum) * 1000000 as bigint) funds, row_number() over (partition by payer order by seq) r
      from {_PREPARED_SQL} where payer is not null),
    walk as (select payer, 0::bigint r, -1::bigint seq, false accepted, max(funds) remaining from debits group by payer
      union all select d.payer, d.r, d.seq, d.debit <= w.remaining, w.remaining - if(d.debit <= w.remaining, d.debit, 0)
      from walk w join debits d on d.payer = w.payer and d.r = w.r + 1)
    select seq, {_ROW_SQL} from {_posted_sql('seq in (select seq from walk where accepted)')}""",
)
def _(spark, folder):
    """Each accepted debit lowers the funds of later ones."""
    ordered = K.post_in_order(requests(spark, folder), accounts(spark, folder), rates(spark))
    return plain(ordered.drop(*K.BOOKING_DETAIL))


@catalog.add(
    "funds_greedy",
    f"""with recursive debits as (select l_suppkey account_id, l_orderkey * 8 + l_linenumber seq,
      cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) debit,
      row_number() over (partition by l_suppkey order by l_orderkey * 8 + l_linenumber) r
      from (select l_suppkey, l_orderkey, l_linenumber, max(l_extendedprice) l_extendedprice from lineitem group by all)),
    walk as (select account_id, 0::bigint r, 0::bigint seq, false accepted, cast(cast(s_acctbal as decimal(18,2)) * 10000 as bigint) remaining
      from (select s_suppkey account_id, s_acctbal from supplier)
      union all select d.account_id, d.r, d.seq, d.debit <= w.remaining, w.remaining - if(d.debit <= w.remaining, d.debit, 0)
      from walk w join debits d on d.account_id = w.account_id and d.r = w.r + 1)
    select 'SA' || account_id account_id, seq, accepted from walk where r > 0""",
)
def _(spark, folder):
    """The rounds of the funds check on all line items as debits of their suppliers."""
    from ..sources.tables import tables

    lineitem, supplier = tables(spark, folder, "lineitem", "supplier")
    cents = F.lit(100)
    debits = (
        lineitem.groupBy("l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))
        .agg((F.max(F.col("l_extendedprice").cast("decimal(18,2)")) * cents).cast("bigint").alias("debit"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_suppkey").alias("account_id"),
            "seq",
            "debit",
            (F.col("s_acctbal").cast("decimal(18,2)") * cents * 100).cast("bigint").alias("funds"),
        )
    )
    # the rounds go by the number of the account, its name is for the result
    named = F.concat(F.lit("SA"), F.col("account_id").cast("string"))
    return plain(accept_in_order(debits).withColumn("account_id", named))


_MICRO = "cast(({}) * 1000000 as bigint)"
# one request of every account a step: the first that is open, once all earlier movements of its payer are decided
_CHAIN_SQL = f"""asked as materialized (select seq, payer, payee, {_MICRO.format("pay + charge")} need,
    if(rate is null, 0, {_MICRO.format("pay + charge")}) "out", if(rate is null, 0, {_MICRO.format("gain")}) "into" from {_PREPARED_SQL}),
  moves as materialized (select payer account, seq, -"out" delta from asked where payer is not null
    union all select payee, seq, "into" from asked where payee in (select payer from asked)),
  chain(seq, ok) using key (seq) as (
    select seq, true from asked where payer is null
    union
    select q.seq, q.need <= any_value(o.funds) + coalesce(sum(m.delta) filter (m.seq < q.seq and c.ok), 0)
    from asked q join (select account, min(seq) seq from moves where seq not in (select seq from recurring.chain) group by account) f
      on f.account = q.payer and f.seq = q.seq
    join (select account_id, {_MICRO.format("current_balance - minimum_balance")} funds from {_ACCOUNTS_SQL}) o on o.account_id = q.payer
    left join moves m on m.account = q.payer left join recurring.chain c on c.seq = m.seq
    group by q.seq, q.need)"""
_CHAINED_SQL = _posted_sql("seq in (select seq from chain where ok)")


def chained(spark, folder):
    return K.post_chained(requests(spark, folder), accounts(spark, folder), rates(spark))


@catalog.add("ledger_post_chained", f"with recursive {_CHAIN_SQL} select seq, {_ROW_SQL} from {_CHAINED_SQL}")
def _(spark, folder):
    """Requests in their true order: what an accepted one brings in, later ones can spend."""
    return plain(chained(spark, folder).drop(*K.BOOKING_DETAIL))


@catalog.add(
    "chained_balances",
    f"""with recursive {_CHAIN_SQL}, l as (select seq, payer account_id, -(pay + charge) signed, 0 side from {_CHAINED_SQL} where funded and payer is not null
      union all select seq, payee, gain, 1 from {_CHAINED_SQL} where funded and payee is not null)
    select l.account_id, seq, {dbl('cast(signed as decimal(18,4))')} signed_amount,
    {dbl('cast(current_balance + sum(signed) over (partition by l.account_id order by seq) as decimal(18,4))')} balance_after
    from l join {_ACCOUNTS_SQL} a on a.account_id = l.account_id""",
)
def _(spark, folder):
    """Both balances after every movement of the ledger in its true order."""
    return plain(K.running_balances(accounts(spark, folder), K.legs(chained(spark, folder))))
