"""Spend monitoring: staging, enrichment, daily and vendor marts, alerts, windows, retraining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import instant, iso_utc
from ..functions.ladders import at_least
from ..functions.numbers import ratio
from ..functions.risk import with_features, with_risk_score, with_rule_flags
from ..functions.text import alert_reason
from ..operators.distinct import distinct_partials, from_partials
from ..operators.panes import sliding_totals

NUMERIC = "decimal(38,9)"
# a dividend of this type makes Spark's decimal quotient keep nine decimals
DIVIDEND = "decimal(29,9)"


def numeric_ratio(top: str, bottom: str) -> Column:
    return ratio(F.col(top).cast(DIVIDEND), bottom)


def score_transactions(transactions: DataFrame, raw: str = "ml_raw_score") -> DataFrame:
    """Rules plus combined risk score for rows that carry a raw model score."""
    return with_risk_score(with_rule_flags(transactions), raw)


def transaction_features(transactions: DataFrame, key: str = "transaction_id") -> DataFrame:
    return with_features(transactions).select(key, *V.FEATURE_NAMES)


def stage_transactions(scored: DataFrame) -> DataFrame:
    def numeric(name: str) -> Column:
        return F.col(name).cast(NUMERIC).alias(name)

    def flag(name: str, alias: str | None = None) -> Column:
        return F.coalesce(F.col(name), F.lit(False)).alias(alias or name)

    return scored.filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id",
        "company_id",
        "vendor_id",
        "company_name",
        "company_size_tier",
        numeric("baseline_monthly_spend"),
        "vendor_name",
        "vendor_category",
        "vendor_risk_tier",
        numeric("amount_usd"),
        "currency",
        "payment_method",
        "department",
        instant("timestamp").alias("transacted_at"),
        flag("is_anomaly", "is_simulated_anomaly"),
        F.col("anomaly_type").alias("simulated_anomaly_type"),
        *[flag(name) for name, _ in V.ALERT_REASONS],
        F.coalesce("rule_flag_count", F.lit(0)).alias("rule_flag_count"),
        flag("any_rule_triggered"),
        "ml_raw_score",
        numeric("ml_anomaly_score"),
        numeric("rule_contribution"),
        numeric("final_risk_score"),
        flag("risk_flag"),
    )


def enrich_transactions(staged: DataFrame) -> DataFrame:
    hour = F.hour("transacted_at")
    return staged.withColumns(
        {
            "risk_tier": at_least("final_risk_score", V.RISK_TIER, V.RISK_TIER_DEFAULT),
            "amount_to_baseline_ratio": numeric_ratio("amount_usd", "baseline_monthly_spend"),
            "transaction_hour": hour,
            "transaction_date": F.to_date("transacted_at"),
            "day_of_week": F.date_format("transacted_at", "EEEE"),
            "is_off_hours": hour.between(V.OFF_HOURS[0], V.OFF_HOURS[1] - 1),
        }
    )


FACT_COLUMNS = [
    "transaction_id",
    "company_id",
    "vendor_id",
    "transacted_at",
    "transaction_date",
    "transaction_hour",
    "day_of_week",
    "company_name",
    "company_size_tier",
    "baseline_monthly_spend",
    "vendor_name",
    "vendor_category",
    "vendor_risk_tier",
    "department",
    "payment_method",
    "currency",
    "amount_usd",
    "amount_to_baseline_ratio",
    "risk_tier",
    "final_risk_score",
    "ml_anomaly_score",
    "rule_flag_count",
    "risk_flag",
    "rule_spend_spike",
    "rule_high_risk_vendor",
    "rule_off_hours",
    "rule_round_amount",
    "any_rule_triggered",
    "is_simulated_anomaly",
    "simulated_anomaly_type",
]


def transaction_facts(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


_DAILY_FLAGS = {
    "risk_flagged_count": "risk_flag",
    "spend_spike_count": "rule_spend_spike",
    "high_risk_vendor_count": "rule_high_risk_vendor",
    "off_hours_count": "rule_off_hours",
    "known_anomaly_count": "is_simulated_anomaly",
}
_DAILY_GROUP = ["transaction_date", "company_id", "company_name", "company_size_tier", "baseline_monthly_spend"]
_DAILY_COUNTED = {"distinct_vendor_count": "vendor_id", "distinct_category_count": "vendor_category"}


def daily_partials(enriched: DataFrame) -> DataFrame:
    """Totals per company, day, vendor and category: what company days of several lots of rows are made of."""
    return distinct_partials(
        enriched,
        _DAILY_GROUP,
        _DAILY_COUNTED,
        {
            "_rows": F.count(F.lit(1)),
            "_amount": F.sum("amount_usd"),
            "_amounts": F.count("amount_usd"),
            "_largest": F.max("amount_usd"),
            **{f"_{name}": F.count_if(flag) for name, flag in _DAILY_FLAGS.items()},
        },
    )


def daily_from_partials(partials: DataFrame) -> DataFrame:
    daily = from_partials(
        partials,
        _DAILY_GROUP,
        _DAILY_COUNTED,
        {
            "transaction_count": F.sum("_rows"),
            "total_amount_usd": F.sum("_amount"),
            "avg_amount_usd": F.try_divide(F.sum("_amount"), F.sum("_amounts")),
            "max_amount_usd": F.max("_largest"),
            **{name: F.sum(f"_{name}") for name in _DAILY_FLAGS},
        },
    )
    return daily.withColumn("daily_to_baseline_ratio", numeric_ratio("total_amount_usd", "baseline_monthly_spend"))


def company_daily_spend(enriched: DataFrame) -> DataFrame:
    return daily_from_partials(daily_partials(enriched))


def company_spend_summary(daily: DataFrame) -> DataFrame:
    """Daily rows with the mean of the last seven rows of the company and an unusual-day mark.

    The window runs over one row per company and day, not over transactions.
    """
    last_rows = (
        Window.partitionBy("company_id").orderBy("transaction_date").rowsBetween(-(V.ROLLING_ROWS - 1), 0)
    )
    rolling = F.col("rolling_7d_avg_spend")
    return (
        daily.withColumn("rolling_7d_avg_spend", F.avg("total_amount_usd").over(last_rows))
        .withColumn("is_unusual_spend_day", F.col("total_amount_usd") > F.lit(V.UNUSUAL_DAY_FACTOR) * rolling)
        .orderBy(F.desc("transaction_date"), F.desc("total_amount_usd"))
    )


ALERT_COLUMNS = [
    "transaction_id",
    "transacted_at",
    "company_id",
    "company_name",
    "company_size_tier",
    "vendor_name",
    "vendor_category",
    "vendor_risk_tier",
    "department",
    "amount_usd",
    "baseline_monthly_spend",
    "amount_to_baseline_ratio",
    "final_risk_score",
    "ml_anomaly_score",
    "risk_tier",
]


def fraud_alerts(facts: DataFrame) -> DataFrame:
    return (
        facts.filter(F.col("risk_flag"))
        .select(
            *ALERT_COLUMNS,
            alert_reason().alias("alert_reason"),
            "rule_flag_count",
            "any_rule_triggered",
            "is_simulated_anomaly",
            "payment_method",
        )
        .orderBy(F.desc("transacted_at"))
    )


def vendor_risk(facts: DataFrame) -> DataFrame:
    summary = facts.groupBy("vendor_id", "vendor_name", "vendor_category", "vendor_risk_tier").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.countDistinct("company_id").alias("distinct_companies"),
        F.sum("amount_usd").alias("total_amount_usd"),
        F.avg("amount_usd").alias("avg_amount_usd"),
        F.max("amount_usd").alias("max_amount_usd"),
        F.count_if("risk_flag").alias("flagged_transaction_count"),
        F.count_if("rule_spend_spike").alias("spend_spike_count"),
        F.count_if("rule_high_risk_vendor").alias("high_risk_vendor_rule_count"),
        F.avg("ml_anomaly_score").alias("avg_ml_anomaly_score"),
        F.max("final_risk_score").alias("max_risk_score"),
        F.min("transacted_at").alias("first_seen"),
        F.max("transacted_at").alias("last_seen"),
    )
    rate, tier = F.col("flag_rate"), F.col("vendor_risk_tier")
    label = (
        F.when((rate >= V.VENDOR_HIGH_RATE) | (tier == "high"), "high")
        .when((rate >= V.VENDOR_MEDIUM_RATE) | (tier == "medium"), "medium")
        .otherwise("low")
    )
    return (
        summary.withColumn("flag_rate", ratio("flagged_transaction_count", "total_transactions"))
        .withColumn("observed_risk_label", label)
        .orderBy(F.desc("flag_rate"), F.desc("total_amount_usd"))
    )


def window_partials(
    scored: DataFrame, time_col: str, size: str = V.SPEND_WINDOW, slide: str | None = None,
    keys: Sequence[str] = ("company_id",),
) -> DataFrame:
    """Mergeable totals per window of `time_col` (column `window`) and key.

    Sliding windows of a batch come from panes, so no row is copied; a stream takes the
    engine's own windows, whose state and watermark it needs.
    """
    amount = F.col("amount_usd").cast(NUMERIC)
    flagged = F.coalesce(F.col("risk_flag"), F.lit(False))
    totals = {
        "company_name": ("min", F.min("company_name")),
        "company_size_tier": ("min", F.min("company_size_tier")),
        "transaction_count": ("sum", F.count(F.lit(1))),
        "_total": ("sum", F.sum(amount)),
        "_max": ("max", F.max(amount)),
        "risk_flagged_count": ("sum", F.count_if(flagged)),
    }
    if slide is not None and not scored.isStreaming:
        return sliding_totals(scored, time_col, size, slide, keys, totals)
    return scored.groupBy(F.window(time_col, size, slide).alias("window"), *keys).agg(
        *[value.alias(name) for name, (_, value) in totals.items()]
    )


def merged_partials(partials: DataFrame, keys: Sequence[str] = ("company_id",)) -> DataFrame:
    """Totals of equal windows and keys as one, e.g. of several batches or days."""
    smallest, added = ("company_name", "company_size_tier"), ("transaction_count", "_total", "risk_flagged_count")
    merged = partials.groupBy("window", *keys).agg(
        *[F.min(c).alias(c) for c in smallest], *[F.sum(c).alias(c) for c in added], F.max("_max").alias("_max")
    )
    return merged.select(*[F.col(f.name).cast(f.dataType) for f in partials.schema.fields])


def window_rows(partials: DataFrame, keys: Sequence[str] = ("company_id",)) -> DataFrame:
    """The rows that are stored for windows with these totals."""

    def money(value: Column) -> Column:
        return F.round(value, 2).cast("double")

    return partials.select(
        iso_utc("window.start").alias("window_start"),
        iso_utc("window.end").alias("window_end"),
        *keys,
        F.coalesce("company_name", F.lit("")).alias("company_name"),
        F.coalesce("company_size_tier", F.lit("")).alias("company_size_tier"),
        "transaction_count",
        money(F.col("_total")).alias("total_amount_usd"),
        money(F.col("_max")).alias("max_amount_usd"),
        money(ratio("_total", "transaction_count")).alias("avg_amount_usd"),
        "risk_flagged_count",
        (F.col("risk_flagged_count") > 0).alias("any_risk_flag"),
    )


def spend_windows(
    scored: DataFrame, time_col: str, size: str = V.SPEND_WINDOW, slide: str | None = None,
    keys: Sequence[str] = ("company_id",),
) -> DataFrame:
    """Per-company aggregates over fixed (or sliding) windows of `time_col`; batch and stream alike.

    Company name and tier come from the smallest values in the window, which makes the
    choice repeatable; they are constant per company.
    """
    return window_rows(window_partials(scored, time_col, size, slide, keys), keys)


def stage_spend_windows(windows: DataFrame) -> DataFrame:
    present = F.col("company_id").isNotNull() & F.col("window_start").isNotNull()
    return windows.filter(present).select(
        "company_id",
        "company_name",
        "company_size_tier",
        instant("window_start").alias("window_start"),
        instant("window_end").alias("window_end"),
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        *[F.col(n).cast(NUMERIC).alias(n) for n in ("total_amount_usd", "max_amount_usd", "avg_amount_usd")],
        F.col("risk_flagged_count").cast("bigint").alias("risk_flagged_count"),
        F.coalesce("any_risk_flag", F.lit(False)).alias("any_risk_flag"),
    )


def last_retrain(audit: DataFrame | None) -> Column | str:
    """Newest audit entry as ISO text, the epoch value when there is no audit yet."""
    if audit is None:
        return V.RETRAIN_EPOCH
    newest = audit.agg(iso_utc(F.max("triggered_at")).alias("m")).first()["m"]
    return newest or V.RETRAIN_EPOCH


def retrain_decision(transactions: DataFrame, since: str, minimum: int = V.RETRAIN_MIN_ROWS) -> DataFrame:
    """One row: rows newer than `since` (compared as text) and whether they suffice to train again."""
    counted = transactions.filter(F.col("timestamp") > since).agg(F.count(F.lit(1)).alias("new_transaction_count"))
    n = F.col("new_transaction_count")
    enough = n >= minimum
    middle = F.lit(f" new transactions since last retrain (threshold: {minimum}). ")
    text = F.when(enough, F.concat(n.cast("string"), middle, F.lit("Retrain recommended."))).otherwise(
        F.concat(F.lit("Only "), n.cast("string"), middle, F.lit("No retrain needed."))
    )
    return counted.select(
        F.lit(since).alias("last_retrain_at"),
        n,
        enough.alias("retrain_triggered"),
        text.alias("reason"),
    )


def audit_entry(decision: DataFrame, now: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if now is None else now
    return decision.select(
        stamp.alias("triggered_at"), "retrain_triggered", "reason", "new_transaction_count"
    )


def evaluation_set(
    transactions: DataFrame, order: Column, variant: Column, off_hours_stamp: str,
    normal: int = 200, unusual: int = 50,
) -> DataFrame:
    """Labelled rows: the first `normal` rows by `order` as they are, and the next `unusual` ones altered.

    Altered rows get, by `variant` (0, 1, 2): fifteen times the amount; a Sunday night time
    and eight times the amount; the whole monthly baseline as amount.
    """
    amount, baseline = F.col("amount_usd"), F.col("baseline_monthly_spend")
    drawn = transactions.withColumn("_o", order)
    plain = drawn.orderBy("_o", "transaction_id").limit(normal).drop("_o").withColumn("label", F.lit(0))
    others = drawn.orderBy(F.desc("_o"), "transaction_id").limit(unusual).drop("_o")
    altered = (
        others.withColumn("_v", variant)
        .withColumn(
            "timestamp", F.when(F.col("_v") == 1, F.lit(off_hours_stamp)).otherwise(F.col("timestamp"))
        )
        .withColumn(
            "amount_usd",
            F.when(F.col("_v") == 0, amount * 15).when(F.col("_v") == 1, amount * 8).otherwise(baseline),
        )
        .drop("_v")
        .withColumn("label", F.lit(1))
    )
    return plain.unionByName(altered)
