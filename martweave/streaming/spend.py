"""Streaming spend monitoring: decode, refuse, score, and aggregate per company."""

from __future__ import annotations

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as V
from ..functions.messages import dead_letters, parse_transactions, valid_rows
from ..functions.risk import with_features
from ..operators.forest import shared_model, with_raw_score
from ..plans.spend import score_transactions, spend_windows

# process what is there and stop; a running service passes {"processingTime": "30 seconds"} or the like
AT_ONCE = {"availableNow": True}

SCORED_COLUMNS = [
    "transaction_id",
    "company_id",
    "company_name",
    "company_size_tier",
    "vendor_id",
    "vendor_name",
    "vendor_category",
    "vendor_risk_tier",
    "amount_usd",
    "currency",
    "payment_method",
    "department",
    "timestamp",
    "is_anomaly",
    "anomaly_type",
    "rule_spend_spike",
    "rule_high_risk_vendor",
    "rule_off_hours",
    "rule_round_amount",
    "rule_flag_count",
    "any_rule_triggered",
    "ml_raw_score",
    "ml_anomaly_score",
    "rule_contribution",
    "final_risk_score",
    "risk_flag",
    "baseline_monthly_spend",
]


def scored(transactions: DataFrame, nodes: DataFrame | Broadcast | None = None) -> DataFrame:
    """Sound transactions with model score and rules; works on batches and streams.

    Without a model every row counts as unscored, which leaves the rules.
    """
    extra = [c for c in transactions.columns if c not in SCORED_COLUMNS]
    if nodes is None:
        rows = transactions.withColumn("ml_raw_score", F.lit(None).cast("double"))
    else:
        features = [f"_f_{n}" for n in V.FEATURE_NAMES]
        rows = with_raw_score(with_features(transactions, "_f_"), nodes, features).drop(*features)
    return score_transactions(rows).select(*SCORED_COLUMNS, *extra)


def write_scored(
    messages: DataFrame, scored_path: str, refused_path: str, checkpoint: str, nodes: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Scored rows and refused messages from one pass over the stream.

    Each batch writes to folders of its own number, so a batch that is run again after a
    failure replaces its rows and does not add them twice.
    """

    model = None if nodes is None else shared_model(nodes)

    def both(batch: DataFrame, number: int) -> None:
        parsed = parse_transactions(batch).persist()
        try:
            good = scored(valid_rows(parsed), model)
            good.write.mode("overwrite").parquet(f"{scored_path}/batch={number}")
            dead_letters(parsed).write.mode("overwrite").json(f"{refused_path}/batch={number}")
        finally:
            parsed.unpersist()

    return (
        messages.writeStream.foreachBatch(both)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )


def scored_stream(messages: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Scored rows of a message stream, as input for the windows."""
    return scored(valid_rows(parse_transactions(messages)), nodes)


def write_windows(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    time_col: str = "arrived_at",
    lateness: str = "0 seconds",
    size: str = V.SPEND_WINDOW,
    slide: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window aggregates of scored rows, each emitted once when the watermark passes its end.

    Late rows are dropped.  Windows go by arrival time unless another time column is named.
    `rows` is `scored_stream(...)` or a stream over the stored scored rows, which saves
    scoring them a second time.
    """
    windows = spend_windows(rows.withWatermark(time_col, lateness), time_col, size, slide)
    return (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )
