"""Registered streaming queries: the given tables replayed as message files through the streams.

Each writes its input, output and checkpoint to a new folder of the shared work folder and
returns what the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..plans import commerce as C
from ..sources.readers import message_files, topic_files
from ..session import run_folder
from ..streaming import commerce as commerce_stream
from ..streaming import spend as spend_stream
from ..streaming.signals import write_signals
from ..streaming.windows import write_windows_once
from . import model, shop, spend
from . import standins as S
from .common import Catalog, big, moment, plain, rounded

catalog = Catalog()

# what the streams are given comes in so many deliveries; a batch takes files of at most so many bytes
DELIVERIES, BATCH_BYTES = 4, 4 << 30


def _parted(standin, spark, folder, by: str, late=0) -> list:
    """The rows that each delivery brings: equal stretches of the integer `by`, some of them later.

    A stretch lies in a few files of a table that is in order, so its rows are dealt to all tasks
    before their texts are made: what reads a delivery has no more tasks than that has files.
    """
    low, high = standin.frame(spark, folder).agg(F.min(F.expr(by)), F.max(F.expr(by)) + 1).first()
    stretch = F.expr(f"({by} - {low or 0}L) * {DELIVERIES} div {(high or 1) - (low or 0)}L")
    delivery = F.least(F.lit(DELIVERIES - 1), stretch + late)
    rows = standin.frame(spark, folder, 2 * spark.sparkContext.defaultParallelism)
    return [rows.filter(delivery == n) for n in range(DELIVERIES)]


def _arrivals(spark, folder, place: str, late=0):
    """The message stream after each delivery; a query is started anew from its checkpoint each time.

    A delivery is written when the one before has been read, so a file store's times decide nothing.
    """
    for rows in _parted(S.MESSAGES, spark, folder, "unix_micros(arrived_at)", late):
        rows.select("value", "arrived_at").write.mode("append").parquet(f"{place}/in")
        yield message_files(spark, f"{place}/in", max_bytes=BATCH_BYTES)


_GOOD_SQL = f"""(select t.transaction_id, t.company_id, t.company_name, if(m.event_id % 50 = 9, null, 'smb') company_size_tier,
  t.vendor_id, t.vendor_category, 'low' vendor_risk_tier, t."timestamp", if(m.event_id % 50 = 7, 1.0, t.amount_usd) amount_usd,
  t.baseline_monthly_spend, t.ts from {S.MESSAGES.sql} m join {S.TRANSACTIONS.sql} t on t.event_id = m.event_id
  where {spend._ERROR_SQL.replace('event_id', 'm.event_id')} is null)"""
_GOOD_FEATURES = f"""(select transaction_id, [amount_usd, if(baseline_monthly_spend > 0, amount_usd / nullif(baseline_monthly_spend, 0), 0.0),
  ln(1 + amount_usd), hour(ts), isodow(ts) - 1, (isodow(ts) >= 6)::int, 0,
  coalesce(nullif(list_position({V.VENDOR_CATEGORIES}, vendor_category), 0) - 1, 0)] v from {_GOOD_SQL})"""
_LOW, _HIGH = V.RAW_SCORE_BOUNDS


@catalog.add(
    "stream_scored",
    f"""select transaction_id, company_id, company_name, company_size_tier, vendor_id, vendor_category, vendor_risk_tier,
    "timestamp", amount_usd, baseline_monthly_spend, spike rule_spend_spike, risky rule_high_risk_vendor, night rule_off_hours,
    round_sum rule_round_amount, {big('fired')} rule_flag_count, fired > 0 any_rule_triggered, {rounded('raw', 6)} ml_raw_score,
    model_score ml_anomaly_score, {rounded('least(fired * 0.2, 0.4)', 4)} rule_contribution,
    {rounded('least(1.0, model_score + least(fired * 0.2, 0.4))', 4)} final_risk_score,
    {rounded('least(1.0, model_score + least(fired * 0.2, 0.4))', 4)} >= {V.RISK_FLAG_AT} risk_flag
    from (select *, spike::int + risky::int + night::int + round_sum::int fired,
      {rounded(f'1.0 - (greatest({_LOW}, least({_HIGH}, raw)) + 0.5) / 0.6', 4)} model_score
      from (select g.*, raw,
        baseline_monthly_spend > 0 and amount_usd > baseline_monthly_spend * {V.EXPECTED_SHARE_OF_BASELINE} * {V.SPEND_SPIKE_MULTIPLIER} spike,
        vendor_risk_tier = 'high' and amount_usd > {V.HIGH_RISK_VENDOR_AMOUNT} risky, hour(ts) < {V.OFF_HOURS[1]} night,
        amount_usd >= {V.ROUND_AMOUNT_FLOOR} and amount_usd % {V.ROUND_AMOUNT_STEP} = 0 round_sum
        from {_GOOD_SQL} g join {model.walk_sql(_GOOD_FEATURES)} w using (transaction_id)))""",
)
def _(spark, folder):
    """Messages decoded, scored by a given forest and by the rules, in several batches."""
    place = run_folder(spark, "scored")
    for messages in _arrivals(spark, folder, place):
        spend_stream.write_scored(
            messages, f"{place}/scored", f"{place}/refused", f"{place}/state", model.given_forest(spark)
        ).awaitTermination()
    other = ["vendor_name", "currency", "payment_method", "department", "is_anomaly", "anomaly_type"]
    columns = [c for c in spend_stream.SCORED_COLUMNS if c not in other]
    return plain(spark.read.parquet(f"{place}/scored").select(*columns))


@catalog.add("stream_dead_letters", spend.catalog.checks["dead_letters"])
def _(spark, folder):
    place = run_folder(spark, "refused")
    for messages in _arrivals(spark, folder, place):
        spend_stream.write_scored(messages, f"{place}/scored", f"{place}/refused", f"{place}/state").awaitTermination()
    return plain(spark.read.json(f"{place}/refused", schema="raw_message string, error string").drop("batch"))


@catalog.add(
    "stream_spend_windows",
    f"""with good as ({spend.catalog.checks['parse_valid']}), arrived as (select 'tx_' || event_id transaction_id,
      time_bucket(interval 5 minute, arrived_at) w, (select max(arrived_at) from {S.MESSAGES.sql}) closing from {S.MESSAGES.sql})
    select strftime(w, '%Y-%m-%dT%H:%M:%S+00:00') window_start, company_id, count(*) transaction_count,
    cast(sum(cast(amount_usd as decimal(18,2))) as double) total_amount_usd
    from good join arrived using (transaction_id) group by w, company_id, closing
    having w + interval 5 minute <= (select max(w2.arrived_at) from {S.MESSAGES.sql} w2 join good g on g.transaction_id = 'tx_' || w2.event_id)""",
)
def _(spark, folder):
    """Windows by arrival time; the one still open when the input ends is not emitted."""
    place = run_folder(spark, "windows")
    for messages in _arrivals(spark, folder, place):
        rows = spend_stream.scored_stream(messages)
        spend_stream.write_windows(rows, f"{place}/windows", f"{place}/state").awaitTermination()
    written = spark.read.parquet(f"{place}/windows")
    return plain(written.select("window_start", "company_id", "transaction_count", "total_amount_usd"))


def _topic_arrivals(spark, folder, place: str):
    """The stream of both topics after each delivery."""
    columns = ["topic", "value", F.lit(0).alias("partition"), "offset", "timestamp"]
    topics = {"a": S.TOPIC_EVENTS, "b": S.TOPIC_ORDERS}
    parted = {name: _parted(standin, spark, folder, "offset") for name, standin in topics.items()}
    for n in range(DELIVERIES):
        for name, rows in parted.items():
            rows[n].select(*columns).write.mode("append").parquet(f"{place}/in/{name}")
        yield topic_files(spark, f"{place}/in/*", max_bytes=BATCH_BYTES)


def _ingest(spark, folder, label: str, put=None) -> str:
    place = run_folder(spark, label)
    for stream in _topic_arrivals(spark, folder, place):
        commerce_stream.ingest(
            stream, f"{place}/events", f"{place}/orders", f"{place}/refused", f"{place}/state",
            None if put else S.GEO_RANGES.frame(spark, folder), put=put,
        ).awaitTermination()
    return place


@catalog.add(
    "stream_order_upsert",
    f"""with docs as (select o_orderkey, o_orderkey // 2 doc, o_custkey, o_totalprice, o_orderpriority, {shop._ORDER_REASON_SQL} reason from orders),
    newest as (select doc, max(o_orderkey) last_key, max(o_orderkey) filter (o_orderkey % 2 = 0) last_even from docs where reason is null group by doc)
    select 'ORD-' || n.doc order_id, 'usr_' || l.o_custkey user_id, cast(cast(l.o_totalprice as decimal(18,2)) as double) total, e.o_orderpriority city
    from newest n join docs l on l.o_orderkey = n.last_key left join docs e on e.o_orderkey = n.last_even""",
)
def _(spark, folder):
    """Orders as they stand after several batches, each merged into what earlier ones stored."""
    place = _ingest(spark, folder, "orders")
    return plain(
        commerce_stream.stored_orders(spark, f"{place}/orders").select(
            "order_id", "user_id", F.col("totals.total").alias("total"), F.col("shipping_address.city").alias("city")
        )
    )


@catalog.add("stream_events", shop.catalog.checks["enriched_events"])
def _(spark, folder):
    place = _ingest(spark, folder, "events")
    octet = F.split("metadata.ip", r"\.")[0].cast("bigint")
    written = spark.read.schema(C.EVENT_SCHEMA).parquet(f"{place}/events")
    fields = ["device_type", "browser", "country", "country_code", "city"]
    return plain(
        written.groupBy("type", "user_id", octet.alias("octet"), *[F.col(f"metadata.{c}").alias(c) for c in fields]).agg(
            F.count(F.lit(1)).alias("n")
        )
    )


# a store that takes documents up to a size only: the write of a longer one raises
LONGEST = 275


def sized_store(longest: int):
    def put(batch) -> None:
        import pyarrow.compute as pc

        sizes = pc.binary_length(batch.column("value").cast("binary"))
        most = pc.max(sizes).as_py()
        if most is not None and most > longest:
            raise ValueError(f"document of {most} bytes exceeds {longest}")

    return put


_SIZE_SQL = "octet_length(encode(value))"
_EVENT_OUTCOME_SQL = f"""(select topic original_topic, value original_value, coalesce({shop._EVENT_REASON_SQL},
  case when {_SIZE_SQL} > {LONGEST} then 'document of ' || {_SIZE_SQL} || ' bytes exceeds {LONGEST}' end) reason from {shop._EVENT_TOPIC_SQL})"""
_ORDER_OUTCOME_SQL = f"""(select topic, value, coalesce({shop._ORDER_REASON_SQL},
  case when {_SIZE_SQL} > {LONGEST} then 'document of ' || {_SIZE_SQL} || ' bytes exceeds {LONGEST}' end) reason
  from (select m.* from {S.TOPIC_ORDERS.sql} m))"""


@catalog.add(
    "stream_write_refusals",
    f"select * from {_EVENT_OUTCOME_SQL} where reason is not null union all select * from {_ORDER_OUTCOME_SQL} where reason is not null",
)
def _(spark, folder):
    """Dead letters of a stream whose store refuses single documents, among all others refused."""
    place = _ingest(spark, folder, "refusals", sized_store(LONGEST))
    shape = "original_topic string, original_value string, reason string, failed_at string"
    envelopes = spark.read.text(f"{place}/refused").select(F.from_json("value", shape).alias("r")).select("r.*")
    return plain(envelopes.drop("failed_at"))


@catalog.add(
    "stream_written_events",
    f"""select json_extract_string(original_value, '$.type') "type", json_extract_string(original_value, '$.user_id') user_id,
    count(*) n from {_EVENT_OUTCOME_SQL} where reason is null group by all""",
)
def _(spark, folder):
    """What the same stream stores: every sound event but those its store refuses."""
    place = _ingest(spark, folder, "written", sized_store(LONGEST))
    written = spark.read.schema(C.EVENT_SCHEMA).parquet(f"{place}/events")
    return plain(written.groupBy("type", "user_id").agg(F.count(F.lit(1)).alias("n")))


# --- late rows ---------------------------------------------------------------------------

LATE_BY = 2
_EDGES_SQL = f"(select min(epoch_us(arrived_at)) low, max(epoch_us(arrived_at)) + 1 high from {S.MESSAGES.sql})"
# deliveries are equal stretches of time; every 37th message comes two deliveries later
_DELIVERED_SQL = f"""(select 'tx_' || event_id transaction_id, arrived_at, time_bucket(interval 5 minute, arrived_at) + interval 5 minute window_end,
  least({DELIVERIES - 1}, (epoch_us(arrived_at) - low) * {DELIVERIES} // (high - low) + if(event_id % 37 = 5, {LATE_BY}, 0)) delivery
  from {S.MESSAGES.sql}, {_EDGES_SQL})"""
_PLACED_SQL = f"""(select g.*, d.arrived_at, d.window_end, d.delivery,
  (select max(e.arrived_at) from {_DELIVERED_SQL} e join good x using (transaction_id) where e.delivery < d.delivery) watermark
  from good g join {_DELIVERED_SQL} d using (transaction_id))"""


def _late():
    return F.when(F.col("event_id") % 37 == 5, LATE_BY).otherwise(0)


def _windows_once(spark, folder, label: str) -> str:
    """A run of the stream per delivery: it is started again from its checkpoint each time."""
    place = run_folder(spark, label)
    for messages in _arrivals(spark, folder, place, _late()):
        stream = spend_stream.scored_stream(messages)
        write_windows_once(stream, f"{place}/windows", f"{place}/late", f"{place}/open", f"{place}/state").awaitTermination()
    return place


@catalog.add(
    "stream_windows_once",
    f"""with good as ({spend.catalog.checks['parse_valid']}), placed as ({_PLACED_SQL})
    select strftime(window_end, '%Y-%m-%dT%H:%M:%S+00:00') window_end, company_id, count(*) transaction_count,
    cast(sum(cast(amount_usd as decimal(18,2))) as double) total_amount_usd
    from placed where watermark is null or window_end > watermark group by window_end, company_id
    having window_end <= (select max(arrived_at) from placed)""",
)
def _(spark, folder):
    """Windows that are emitted once, over four deliveries with late messages among them."""
    place = _windows_once(spark, folder, "once")
    return plain(spark.read.parquet(f"{place}/windows").select("window_end", "company_id", "transaction_count", "total_amount_usd"))


@catalog.add(
    "stream_late_rows",
    f"""with good as ({spend.catalog.checks['parse_valid']})
    select transaction_id, company_id, {moment('window_end')} window_end, {moment('watermark')} watermark
    from {_PLACED_SQL} where window_end <= watermark""",
)
def _(spark, folder):
    """The messages that came after their window was emitted."""
    place = _windows_once(spark, folder, "late")
    return plain(spark.read.parquet(f"{place}/late").select("transaction_id", "company_id", "window_end", "watermark"))


# --- live signals ------------------------------------------------------------------------

LOOK_BACK, SIGNAL_LATENESS = 360, "1 day"
_SIGNAL_ROWS_SQL = f"(select g.transaction_id, g.company_id, g.vendor_category, d.arrived_at t, d.delivery n from good g join {_DELIVERED_SQL} d using (transaction_id))"


@catalog.add(
    "stream_live_signals",
    f"""with good as ({spend.catalog.checks['parse_valid']}), p as materialized {_SIGNAL_ROWS_SQL},
    marks as (select d n, max(t) - interval {SIGNAL_LATENESS} mark from range({DELIVERIES}) r(d) left join p on p.n < d group by d),
    newest as (select company_id, d n, max(t) top from range({DELIVERIES}) r(d) join p on p.n < d group by all),
    firsts as (select transaction_id, row_number() over (partition by company_id, vendor_category order by n, t, transaction_id) = 1 new_category from p)
    select a.transaction_id, a.company_id, new_category, m.mark is null or a.t >= m.mark history_complete,
      count(*) filter (b.t between a.t - interval {LOOK_BACK} minute and a.t) recent_count,
      {rounded("date_diff('microsecond', max(b.t) filter ((b.t, b.n, b.transaction_id) < (a.t, a.n, a.transaction_id)), a.t) / 1000000.0", 6)} seconds_since_last
    from p a join firsts using (transaction_id) join marks m on m.n = a.n left join newest x on x.n = a.n and x.company_id = a.company_id
    join p b on b.company_id = a.company_id and (b.n = a.n or b.n < a.n and (b.t >= m.mark - interval {LOOK_BACK} minute or b.t = x.top))
    group by a.transaction_id, a.company_id, a.t, new_category, m.mark""",
)
def _(spark, folder):
    """Velocity, new categories and time since the last payment, over four deliveries with late messages among them."""
    place = run_folder(spark, "signals")
    for messages in _arrivals(spark, folder, place, _late()):
        stream = spend_stream.scored_stream(messages)
        write_signals(
            stream, f"{place}/signals", f"{place}/seen", f"{place}/state", minutes=LOOK_BACK, lateness=SIGNAL_LATENESS
        ).awaitTermination()
    columns = ["transaction_id", "company_id", "recent_count", "seconds_since_last", "new_category", "history_complete"]
    return plain(spark.read.parquet(f"{place}/signals").select(*columns), {"seconds_since_last": 6})
