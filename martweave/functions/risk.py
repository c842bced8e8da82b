"""Spend rules, model features and the combined risk score, all as column expressions.

Training and scoring call the same functions, so the two cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .dates import wall_clock, weekday_monday0
from .numbers import clamp, ratio_or_zero
from .plan import once, once_all


def spend_spike() -> Column:
    baseline = F.col("baseline_monthly_spend").cast("double")
    limit = baseline * V.EXPECTED_SHARE_OF_BASELINE * V.SPEND_SPIKE_MULTIPLIER
    return F.coalesce((baseline > 0) & (F.col("amount_usd").cast("double") > limit), F.lit(False))


def high_risk_vendor() -> Column:
    test = (F.col("vendor_risk_tier") == "high") & (F.col("amount_usd") > V.HIGH_RISK_VENDOR_AMOUNT)
    return F.coalesce(test, F.lit(False))


def off_hours() -> Column:
    first, past = V.OFF_HOURS
    hour = F.hour(wall_clock("timestamp"))
    return F.coalesce((hour >= first) & (hour < past), F.lit(False))


def round_amount() -> Column:
    amount = F.col("amount_usd").cast("double")
    test = (amount >= V.ROUND_AMOUNT_FLOOR) & (amount % V.ROUND_AMOUNT_STEP == 0)
    return F.coalesce(test, F.lit(False))


def with_rule_flags(df: DataFrame) -> DataFrame:
    flagged = once_all(
        df,
        {
            "rule_spend_spike": spend_spike(),
            "rule_high_risk_vendor": high_risk_vendor(),
            "rule_off_hours": off_hours(),
            "rule_round_amount": round_amount(),
        },
    )
    fired = sum(
        (F.col(name).cast("int") for name, _ in V.ALERT_REASONS),
        start=F.lit(0),
    )
    return flagged.withColumn("rule_flag_count", fired).withColumn(
        "any_rule_triggered", F.col("rule_flag_count") > 0
    )


def feature_columns(clock: Column | None = None) -> dict[str, Column]:
    """The eight model inputs.  All are null when amount, baseline or time cannot be read.

    `clock` is the transaction's own clock time where the caller has it already.
    """
    amount = F.col("amount_usd").cast("double")
    baseline = F.col("baseline_monthly_spend").cast("double")
    clock = wall_clock("timestamp") if clock is None else clock
    weekday = weekday_monday0(clock)
    pairs = [F.lit(x) for i, name in enumerate(V.VENDOR_CATEGORIES) for x in (name, float(i))]
    codes = F.create_map(*pairs)
    values = [
        amount,
        F.when(amount.isNotNull() & baseline.isNotNull(), ratio_or_zero(amount, baseline)),
        F.log1p(amount),
        F.hour(clock).cast("double"),
        weekday.cast("double"),
        (weekday >= 5).cast("double"),
        F.coalesce(F.col("vendor_risk_tier") == "high", F.lit(False)).cast("double"),
        F.coalesce(codes[F.col("vendor_category")], F.lit(0.0)),
    ]
    return dict(zip(V.FEATURE_NAMES, values, strict=True))


def with_features(df: DataFrame, prefix: str = "") -> DataFrame:
    """Adds the model inputs; the time text is parsed once per row, and so is each input computed."""
    timed = once(df, wall_clock("timestamp"), "_clock")
    named = {f"{prefix}{name}": c for name, c in feature_columns(F.col("_clock")).items()}
    replaced = [c for c in df.columns if c not in named]
    packed = once(timed, F.struct(*[c.alias(n) for n, c in named.items()]), "_features")
    return packed.select(*replaced, *[F.col(f"_features.{n}").alias(n) for n in named])


def feature_vector() -> Column:
    return F.array(*feature_columns().values())


def normalised_score(raw, low: float = V.RAW_SCORE_BOUNDS[0], high: float = V.RAW_SCORE_BOUNDS[1]) -> Column:
    """Raw forest score to 0..1, 1 being the most unusual."""
    clamped = clamp(raw, low, high)
    return F.round(F.lit(1.0) - (clamped - F.lit(low)) / F.lit(round(high - low, 12)), 4)


def with_risk_score(df: DataFrame, raw: str = "ml_raw_score") -> DataFrame:
    """Adds model score, rule part, final score and flag.  A row the model could not score counts as 0."""
    rule_part = F.least(F.col("rule_flag_count") * V.RULE_CONTRIBUTION, F.lit(V.RULE_CONTRIBUTION_CAP))
    parts = once_all(
        df.withColumnRenamed(raw, "_raw"),
        {
            "ml_raw_score": F.round(F.coalesce(F.col("_raw").cast("double"), F.lit(0.0)), 6),
            "ml_anomaly_score": F.when(F.col("_raw").isNull(), F.lit(0.0)).otherwise(
                normalised_score(F.col("_raw").cast("double"))
            ),
            "rule_contribution": F.round(rule_part, 4),
        },
    ).drop("_raw")
    final = F.round(F.least(F.lit(1.0), F.col("ml_anomaly_score") + F.col("rule_contribution")), 4)
    return once_all(parts, {"final_risk_score": final}).withColumn(
        "risk_flag", F.col("final_risk_score") >= V.RISK_FLAG_AT
    )
