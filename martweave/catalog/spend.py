"""Registered spend queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.messages import dead_letters, parse_transactions, valid_rows
from ..functions.risk import with_rule_flags
from ..operators import forest
from ..operators.marts import DailyMart
from ..plans import spend as P
from ..session import run_folder
from ..sources.sinks import row_counts
from . import standins as S
from .common import Catalog, big, dbl, moment, nth_sql, plain, rounded, shared, shared_rows, steps_sql

catalog = Catalog()

FLAGS = [name for name, _ in V.ALERT_REASONS]


def transactions(spark, folder):
    return S.TRANSACTIONS.frame(spark, folder)


# of the spend suites, which all read the scored rows
scored_once = shared_rows


def scored(spark, folder):
    return shared(folder, "scored", lambda: P.score_transactions(transactions(spark, folder)))


def enriched(spark, folder):
    return shared(folder, "enriched", lambda: P.enrich_transactions(P.stage_transactions(scored(spark, folder))))


def facts(spark, folder):
    return P.transaction_facts(enriched(spark, folder))


# the written clock is the event time; its instant is 5.5 hours earlier in rows with an offset
_TXN_SQL = f"""(select t.*, if({S.OFFSET_ROW}, ts - interval '330 minutes', ts) at_utc,
  baseline_monthly_spend > 0 and amount_usd > baseline_monthly_spend * {V.EXPECTED_SHARE_OF_BASELINE} * {V.SPEND_SPIKE_MULTIPLIER} spike,
  vendor_risk_tier = 'high' and amount_usd > {V.HIGH_RISK_VENDOR_AMOUNT} risky,
  hour(ts) < {V.OFF_HOURS[1]} night,
  amount_usd >= {V.ROUND_AMOUNT_FLOOR} and amount_usd % {V.ROUND_AMOUNT_STEP} = 0 round_sum
  from {S.TRANSACTIONS.sql} t)"""
_FLAG_SQL = f"(select *, spike::int + risky::int + night::int + round_sum::int fired from {_TXN_SQL})"
_LOW, _HIGH = V.RAW_SCORE_BOUNDS
_SCORED_SQL = f"""(select *, least(1.0, model_score + rule_part) final_score from
  (select *, if(ml_raw_score is null, 0.0, {rounded(f'1.0 - (greatest({_LOW}, least({_HIGH}, ml_raw_score)) + 0.5) / 0.6', 4)}) model_score,
   least(fired * 0.2, 0.4) rule_part from {_FLAG_SQL}))"""


@catalog.add(
    "rule_flags",
    f"""select transaction_id, spike rule_spend_spike, risky rule_high_risk_vendor, night rule_off_hours,
    round_sum rule_round_amount, {big('fired')} rule_flag_count, fired > 0 any_rule_triggered from {_FLAG_SQL}""",
)
def _(spark, folder):
    flagged = with_rule_flags(transactions(spark, folder))
    return plain(flagged.select("transaction_id", *FLAGS, "rule_flag_count", "any_rule_triggered"))


@catalog.add(
    "features",
    f"""select transaction_id, amount_usd,
    if(baseline_monthly_spend > 0, {rounded('amount_usd / nullif(baseline_monthly_spend, 0)', 9)}, 0.0) amount_to_baseline_ratio,
    {rounded('ln(1 + amount_usd)', 9)} log_amount, {dbl('hour(ts)')} hour_of_day, {dbl('isodow(ts) - 1')} day_of_week,
    {dbl('isodow(ts) >= 6')} is_weekend, {dbl("vendor_risk_tier = 'high'")} is_high_risk_vendor,
    {dbl(f"coalesce(nullif(list_position({V.VENDOR_CATEGORIES}, vendor_category), 0) - 1, 0)")} vendor_category_encoded
    from {_TXN_SQL}""",
)
def _(spark, folder):
    features = P.transaction_features(transactions(spark, folder))
    return plain(features, {"amount_to_baseline_ratio": 9, "log_amount": 9})


@catalog.add(
    "risk_score",
    f"""select transaction_id, coalesce(ml_raw_score, 0.0) ml_raw_score, model_score ml_anomaly_score,
    {rounded('rule_part', 4)} rule_contribution, {rounded('final_score', 4)} final_risk_score,
    {rounded('final_score', 4)} >= {V.RISK_FLAG_AT} risk_flag from {_SCORED_SQL}""",
)
def _(spark, folder):
    columns = ["ml_raw_score", "ml_anomaly_score", "rule_contribution", "final_risk_score", "risk_flag"]
    return plain(scored(spark, folder).select("transaction_id", *columns))


_STAGED_SQL = f"""(select transaction_id, company_id, vendor_id, company_name, company_size_tier, baseline_monthly_spend,
  vendor_name, vendor_category, vendor_risk_tier, amount_usd, cast(amount_usd as decimal(18,2)) amount, currency,
  payment_method, department, at_utc transacted_at, coalesce(is_anomaly, false) is_simulated_anomaly,
  anomaly_type simulated_anomaly_type, spike rule_spend_spike, risky rule_high_risk_vendor, night rule_off_hours,
  round_sum rule_round_amount, {big('fired')} rule_flag_count, fired > 0 any_rule_triggered,
  coalesce(ml_raw_score, 0.0) ml_raw_score, model_score ml_anomaly_score, {rounded('rule_part', 4)} rule_contribution,
  {rounded('final_score', 4)} final_risk_score, {rounded('final_score', 4)} >= {V.RISK_FLAG_AT} risk_flag
  from {_SCORED_SQL})"""


@catalog.add(
    "staged_transactions",
    f"select * exclude (amount, transacted_at), {moment('transacted_at')} transacted_at from {_STAGED_SQL}",
)
def _(spark, folder):
    return plain(P.stage_transactions(scored(spark, folder)))


_ENRICHED_SQL = f"""(select *, {steps_sql('final_risk_score', V.RISK_TIER, f"'{V.RISK_TIER_DEFAULT}'")} risk_tier,
  {rounded('amount_usd / nullif(baseline_monthly_spend, 0)', 9)} amount_to_baseline_ratio, hour(transacted_at) transaction_hour,
  cast(transacted_at as date) on_day, dayname(transacted_at) day_of_week from {_STAGED_SQL})"""


@catalog.add(
    "transactions_enriched",
    f"""select * exclude (amount, transacted_at, on_day), {moment('transacted_at')} transacted_at,
    cast(on_day as varchar) transaction_date, transaction_hour <= 4 is_off_hours from {_ENRICHED_SQL}""",
)
def _(spark, folder):
    return plain(enriched(spark, folder))


_FACT_LIST = ", ".join(
    {"transacted_at": moment("transacted_at") + " transacted_at", "transaction_date": "cast(on_day as varchar) transaction_date"}.get(c, c)
    for c in P.FACT_COLUMNS
)


@catalog.add("fct_transactions", f"select {_FACT_LIST} from {_ENRICHED_SQL}")
def _(spark, folder):
    return plain(facts(spark, folder))


_DAILY_SQL = f"""(select on_day, company_id, company_name, company_size_tier, baseline_monthly_spend,
  count(*) transaction_count, count(distinct vendor_id) distinct_vendor_count,
  count(distinct vendor_category) distinct_category_count, sum(amount) total, avg(amount) mean, max(amount) largest,
  count(*) filter (risk_flag) risk_flagged_count, count(*) filter (rule_spend_spike) spend_spike_count,
  count(*) filter (rule_high_risk_vendor) high_risk_vendor_count, count(*) filter (rule_off_hours) off_hours_count,
  count(*) filter (is_simulated_anomaly) known_anomaly_count from {_ENRICHED_SQL} group by all)"""
_DAILY_LIST = f"""cast(on_day as varchar) transaction_date, * exclude (on_day, total, mean, largest),
  {dbl('total')} total_amount_usd, {rounded('mean', 6)} avg_amount_usd, {dbl('largest')} max_amount_usd,
  {rounded('total / nullif(baseline_monthly_spend, 0)', 9)} daily_to_baseline_ratio"""
_DAILY_DIGITS = {"avg_amount_usd": 6}


@catalog.add("company_daily_spend", f"select {_DAILY_LIST} from {_DAILY_SQL}")
def _(spark, folder):
    return plain(P.company_daily_spend(enriched(spark, folder)), _DAILY_DIGITS)


RUNS = 3


@catalog.add("incremental_daily_spend", f"select {_DAILY_LIST} from {_DAILY_SQL}")
def _(spark, folder):
    """The same mart brought up to date by runs, each with its stretch of days and some rows that were late for theirs."""
    mart = DailyMart(run_folder(spark, "daily"), "transaction_date", P.daily_partials, P.daily_from_partials)
    late = F.when(F.crc32("transaction_id") % 37 == 5, 1).otherwise(0)
    stretch = F.expr(f"(day(transaction_date) - 1) * {RUNS} div 31")
    rows = enriched(spark, folder).withColumn("_lot", F.coalesce(F.least(F.lit(RUNS - 1), stretch + late), F.lit(0)))
    for run in range(RUNS):
        mart.update(rows.filter(F.col("_lot") == run), run)
    return plain(mart.rows(spark), _DAILY_DIGITS)


@catalog.add(
    "company_spend_summary",
    f"""select {_DAILY_LIST.replace('* exclude (on_day,', '* exclude (on_day, rolling,')}, {rounded('rolling', 6)} rolling_7d_avg_spend,
    total > {V.UNUSUAL_DAY_FACTOR} * rolling is_unusual_spend_day
    from (select *, avg(total) over (partition by company_id order by on_day rows {V.ROLLING_ROWS - 1} preceding) rolling from {_DAILY_SQL})""",
)
def _(spark, folder):
    summary = P.company_spend_summary(P.company_daily_spend(enriched(spark, folder)))
    return plain(summary, {**_DAILY_DIGITS, "rolling_7d_avg_spend": 6})


_REASONS_SQL = " || ".join(f"if({flag}, '{reason}', '')" for flag, reason in V.ALERT_REASONS)


@catalog.add(
    "fraud_alerts",
    f"""select {', '.join(moment(c) + ' ' + c if c == 'transacted_at' else c for c in P.ALERT_COLUMNS)},
    trim({_REASONS_SQL} || if(ml_anomaly_score > {V.ALERT_MODEL_SCORE} and rule_flag_count = 0, '{V.ALERT_MODEL_ONLY}', '')) alert_reason,
    rule_flag_count, any_rule_triggered, is_simulated_anomaly, payment_method from {_ENRICHED_SQL} where risk_flag""",
)
def _(spark, folder):
    return plain(P.fraud_alerts(facts(spark, folder)))


@catalog.add(
    "vendor_risk",
    f"""select vendor_id, vendor_name, vendor_category, vendor_risk_tier, n total_transactions,
    companies distinct_companies, {dbl('total')} total_amount_usd, {rounded('mean', 6)} avg_amount_usd,
    {dbl('largest')} max_amount_usd, flagged flagged_transaction_count, spikes spend_spike_count,
    risky high_risk_vendor_rule_count, {rounded('model_mean', 6)} avg_ml_anomaly_score, worst max_risk_score,
    {moment('seen_first')} first_seen, {moment('seen_last')} last_seen, {rounded('flagged / n', 6)} flag_rate,
    case when flagged / n >= {V.VENDOR_HIGH_RATE} or vendor_risk_tier = 'high' then 'high'
      when flagged / n >= {V.VENDOR_MEDIUM_RATE} or vendor_risk_tier = 'medium' then 'medium' else 'low' end observed_risk_label
    from (select vendor_id, vendor_name, vendor_category, vendor_risk_tier, count(*) n, count(distinct company_id) companies,
      sum(amount) total, avg(amount) mean, max(amount) largest, count(*) filter (risk_flag) flagged,
      count(*) filter (rule_spend_spike) spikes, count(*) filter (rule_high_risk_vendor) risky,
      avg(cast(ml_anomaly_score as decimal(10,4))) model_mean, max(final_risk_score) worst,
      min(transacted_at) seen_first, max(transacted_at) seen_last
      from {_ENRICHED_SQL} group by vendor_id, vendor_name, vendor_category, vendor_risk_tier)""",
)
def _(spark, folder):
    digits = {"avg_amount_usd": 6, "avg_ml_anomaly_score": 6, "flag_rate": 6}
    return plain(P.vendor_risk(facts(spark, folder)), digits)


def _windows_sql(time: str) -> str:
    """Window rows from the scored stand-in; starts and ends as ISO text."""
    return f"""(select strftime(w, '%Y-%m-%dT%H:%M:%S+00:00') window_start,
    strftime(w + interval 5 minute, '%Y-%m-%dT%H:%M:%S+00:00') window_end, company_id, min(company_name) company_name,
    min(company_size_tier) company_size_tier, count(*) transaction_count, {dbl('sum(cast(amount_usd as decimal(18,2)))')} total_amount_usd,
    max(amount_usd) max_amount_usd, {rounded('avg(cast(amount_usd as decimal(18,2)))', 2)} avg_amount_usd,
    count(*) filter ({rounded('final_score', 4)} >= {V.RISK_FLAG_AT}) risk_flagged_count,
    count(*) filter ({rounded('final_score', 4)} >= {V.RISK_FLAG_AT}) > 0 any_risk_flag
    from (select *, time_bucket(interval 5 minute, {time}) w from {_SCORED_SQL}) group by w, company_id)"""


@catalog.add("spend_windows_5m", f"select * from {_windows_sql('ts')}")
def _(spark, folder):
    return plain(P.spend_windows(scored(spark, folder), "ts"))


@catalog.add("spend_windows_event_time", f"select * from {_windows_sql('at_utc')}")
def _(spark, folder):
    rows = scored(spark, folder).withColumn("occurred_at", F.col("timestamp").cast("timestamp"))
    return plain(P.spend_windows(rows, "occurred_at"))


@catalog.add(
    "staged_spend_windows",
    f"""select * replace ({moment("strptime(window_start, '%Y-%m-%dT%H:%M:%S+00:00')")} as window_start,
    {moment("strptime(window_end, '%Y-%m-%dT%H:%M:%S+00:00')")} as window_end) from {_windows_sql('ts')}""",
)
def _(spark, folder):
    return plain(P.stage_spend_windows(P.spend_windows(scored(spark, folder), "ts")))


# --- decoding of messages -----------------------------------------------------------

# which rows of the message stand-in are damaged, and how, follows from its key
_ERROR_SQL = """case event_id % 50
  when 1 then 'invalid JSON' when 3 then 'invalid JSON' when 11 then 'invalid JSON' when 12 then 'invalid JSON'
  when 13 then 'invalid JSON' when 14 then 'not a JSON object'
  when 0 then 'Missing required fields: baseline_monthly_spend' when 10 then 'Missing required fields: baseline_monthly_spend'
  when 2 then 'could not convert amount_usd to float: ''abc''' when 6 then 'could not convert amount_usd to float: ''12d'''
  when 8 then 'could not convert amount_usd to float: ''[1]''' when 4 then 'not a number: amount_usd is null' end"""


def parsed(spark, folder):
    return parse_transactions(S.MESSAGES.frame(spark, folder))


@catalog.add(
    "parse_valid",
    f"""select t.transaction_id, t.company_id, t.company_name, if(m.event_id % 50 = 9, null, 'smb') company_size_tier, t.vendor_id,
    t.vendor_category, 'low' vendor_risk_tier, t."timestamp", if(m.event_id % 50 = 7, 1.0, t.amount_usd) amount_usd,
    t.baseline_monthly_spend from {S.MESSAGES.sql} m join {S.TRANSACTIONS.sql} t on t.event_id = m.event_id
    where {_ERROR_SQL.replace('event_id', 'm.event_id')} is null""",
)
def _(spark, folder):
    columns = [
        "transaction_id",
        "company_id",
        "company_name",
        "company_size_tier",
        "vendor_id",
        "vendor_category",
        "vendor_risk_tier",
        "timestamp",
        "amount_usd",
        "baseline_monthly_spend",
    ]
    return plain(valid_rows(parsed(spark, folder)).select(*columns))


@catalog.add(
    "dead_letters",
    f"select value raw_message, {_ERROR_SQL} error from {S.MESSAGES.sql} where {_ERROR_SQL} is not null",
)
def _(spark, folder):
    return plain(dead_letters(parsed(spark, folder)))


# --- retraining ------------------------------------------------------------------------

SINCE = "2024-01-20T00:00:00+00:00"


def _decision_sql(since: str) -> str:
    middle = f"' new transactions since last retrain (threshold: {V.RETRAIN_MIN_ROWS}). '"
    return f"""select '{since}' last_retrain_at, n new_transaction_count, n >= {V.RETRAIN_MIN_ROWS} retrain_triggered,
    if(n >= {V.RETRAIN_MIN_ROWS}, n || {middle} || 'Retrain recommended.', 'Only ' || n || {middle} || 'No retrain needed.') reason
    from (select count(*) n from {S.TRANSACTIONS.sql} where "timestamp" > '{since}')"""


@catalog.add("retrain_decision", _decision_sql(SINCE))
def _(spark, folder):
    return plain(P.retrain_decision(transactions(spark, folder), SINCE))


@catalog.add("retrain_decision_first_run", _decision_sql(V.RETRAIN_EPOCH))
def _(spark, folder):
    return plain(P.retrain_decision(transactions(spark, folder), P.last_retrain(None)))


@catalog.add(
    "training_rows",
    f"""select count(*) filter (event_id % 23 <> 0) usable_rows, count(*) filter (event_id % 23 = 0) skipped_rows
    from {S.TRANSACTIONS.sql}""",
)
def _(spark, folder):
    """Training rows after features, with some unreadable times among the input."""
    rows = transactions(spark, folder)
    damaged = F.when(F.col("event_id") % 23 == 0, F.lit("not a time")).otherwise(F.col("timestamp"))
    features = P.transaction_features(rows.withColumn("timestamp", damaged))
    return plain(forest.training_matrix(features, V.FEATURE_NAMES))


_ORDER_SQL = "((event_id % 1000003) * 7919 + 17) % 1000003"
SUNDAY_NIGHT = "2024-01-07T03:00:00+00:00"


def _draw(seed: int):
    return ((F.col("event_id") % 1000003) * 7919 + F.lit(seed)) % 1000003


@catalog.add(
    "evaluation_set",
    f"""with d as (select *, {_ORDER_SQL} o from {S.TRANSACTIONS.sql}),
    ranked as (select *, row_number() over (order by o, transaction_id) up, row_number() over (order by o desc, transaction_id) down from d)
    select transaction_id, "timestamp", {rounded('amount_usd', 4)} amount_usd, 0::bigint as label from ranked where up <= 200
    union all select transaction_id, if(event_id % 3 = 1, '{SUNDAY_NIGHT}', "timestamp"),
    {rounded(f"case event_id % 3 when 0 then amount_usd * 15 when 1 then amount_usd * 8 else baseline_monthly_spend end", 4)}, 1
    from ranked where down <= 50""",
)
def _(spark, folder):
    rows = P.evaluation_set(transactions(spark, folder), _draw(17), F.col("event_id") % 3, SUNDAY_NIGHT)
    return plain(rows.select("transaction_id", "timestamp", "amount_usd", "label"), {"amount_usd": 4})


@catalog.add(
    "table_row_counts",
    f"""select 'scored' "table", count(*) "rows", null::varchar error from {S.TRANSACTIONS.sql}
    union all select 'fraud_alerts', count(*), null from {_STAGED_SQL} where risk_flag
    union all select 'vendor_risk', count(distinct vendor_id), null from {_STAGED_SQL}
    union all select 'no_such_table', null, 'missing'""",
)
def _(spark, folder):
    counts = row_counts(
        spark,
        {
            "scored": lambda: scored(spark, folder),
            "fraud_alerts": lambda: P.fraud_alerts(facts(spark, folder)),
            "vendor_risk": lambda: P.vendor_risk(facts(spark, folder)),
            "no_such_table": lambda: spark.table("no_such_table"),
        },
    )
    return plain(counts.withColumn("error", F.when(F.col("error").isNotNull(), F.lit("missing"))))
