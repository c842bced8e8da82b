"""Decoding and checking of JSON messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .dates import is_iso_text
from .numbers import float_from_text
from .plan import once

TRANSACTION_TEXT_FIELDS = [
    "transaction_id",
    "company_id",
    "company_name",
    "company_size_tier",
    "vendor_id",
    "vendor_name",
    "vendor_category",
    "vendor_risk_tier",
    "currency",
    "payment_method",
    "department",
    "timestamp",
    "anomaly_type",
]


def member(doc: Column, path: str, kind: str = "string") -> Column:
    """Part of a document by its path, which starts with a dot or an index."""
    return F.try_variant_get(doc, f"${path}", kind)


def with_document(df: DataFrame, text: Column, members: Iterable[str]) -> DataFrame:
    """Adds `doc`, the text as a variant, null unless it is exactly one JSON value, and `m`,
    the text of each named member.

    The parser stops after the first value and would accept trailing junk, so the text is
    parsed as the only element of an array.  Junk that itself closes the array is caught
    by a second parse as an object field, done only for texts in which it is possible.
    """
    wrapped = once(df, F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "_wrapped")
    alone = member(F.col("_wrapped"), "[1]", "variant").isNull()
    as_field = F.try_parse_json(F.concat(F.lit('{"d":'), text, F.lit("}")))
    sound = F.when(text.rlike(r"\}\s*\]"), as_field.isNotNull()).otherwise(F.lit(True))
    doc = F.when(alone & sound, member(F.col("_wrapped"), "[0]", "variant"))
    parsed = once(wrapped, doc, "doc").drop("_wrapped")
    return once(parsed, F.struct(*[member(F.col("doc"), f".{name}").alias(name) for name in members]), "m")


def _text(key: str) -> Column:
    return F.col(f"m.{key}")


def _is_string(key: str) -> Column:
    """Whether the member is JSON text; asked only where its text could also be another kind."""
    return F.schema_of_variant(member(F.col("doc"), f".{key}", "variant")) == "STRING"


def _absent(key: str) -> Column:
    """Whether the key is missing; a present null is not."""
    return F.when(_text(key).isNull(), member(F.col("doc"), f".{key}", "variant").isNull()).otherwise(F.lit(False))


def _number(key: str) -> Column:
    """Member as double: JSON numbers, booleans and numeric texts convert, anything else is null."""
    text = _text(key)
    return F.when(
        text.isin("true", "false"), F.when(~_is_string(key), (text == "true").cast("double"))
    ).otherwise(float_from_text(text))


def _number_error(key: str) -> Column:
    text = _text(key)
    return F.when(
        _number(key).isNull(),
        F.when(text.isNull(), F.lit(f"not a number: {key} is null")).otherwise(
            F.concat(F.lit(f"could not convert {key} to float: '"), text, F.lit("'"))
        ),
    )


def _missing_error(required: Iterable[str]) -> Column:
    absent = F.array_compact(F.array(*[F.when(_absent(key), F.lit(key)) for key in sorted(required)]))
    # most messages have a text in every required member
    some_null = F.lit(False)
    for key in required:
        some_null = some_null | _text(key).isNull()
    return F.when(
        some_null,
        F.when(F.size(absent) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(absent, ", "))),
    )


def _starts_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


def parse_transactions(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per message: `raw_message`, `error` (null when sound) and the decoded fields.

    Text fields keep null values: a required key must be present, not filled.  Columns of
    the input other than the message (arrival time, offsets) pass through.
    """
    keep = [c for c in messages.columns if c != value]
    raw = messages.select(*keep, F.coalesce(F.col(value).cast("string"), F.lit("")).alias("raw_message"))
    numbers = ["amount_usd", "baseline_monthly_spend"]
    decoded = with_document(raw, F.col("raw_message"), [*TRANSACTION_TEXT_FIELDS, *numbers])
    error = F.coalesce(
        F.when(F.col("doc").isNull(), F.lit("invalid JSON")),
        F.when(~_starts_object(F.col("raw_message")), F.lit("not a JSON object")),
        _missing_error(V.REQUIRED_TRANSACTION_FIELDS),
        *[_number_error(name) for name in numbers],
    )
    return decoded.select(
        *keep,
        "raw_message",
        error.alias("error"),
        *[_text(name).alias(name) for name in TRANSACTION_TEXT_FIELDS],
        *[_number(name).alias(name) for name in numbers],
        member(F.col("doc"), ".is_anomaly", "boolean").alias("is_anomaly"),
    )


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("raw_message", "error")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("raw_message", "error")


def _falsy(key: str) -> Column:
    """Missing, null, empty text, zero, false, empty list or empty object."""
    text = _text(key)
    empty_looking = text.isin("false", "[]", "{}") | (text.rlike(r"^-?0[0.eE+-]*$") & (text.try_cast("double") == 0))
    return F.coalesce((text == "") | F.when(empty_looking, ~_is_string(key)).otherwise(F.lit(False)), F.lit(True))


def _first_falsy(required: Iterable[str]) -> Column:
    return F.coalesce(*[F.when(_falsy(key), F.lit(f"missing required field: '{key}'")) for key in required])


def _not_in(key: str, allowed, label: str) -> Column:
    text = _text(key)
    return F.when(~text.isin(*allowed), F.concat(F.lit(f"invalid {label}: '"), text, F.lit("'")))


def event_error() -> Column:
    """First reason an event is refused, null when it is sound."""
    stamp = _text("timestamp")
    return F.coalesce(
        _first_falsy(V.EVENT_REQUIRED),
        _not_in("type", V.EVENT_TYPES, "event type"),
        F.when(~is_iso_text(stamp), F.concat(F.lit("unparseable timestamp: '"), stamp, F.lit("'"))),
    )


def order_error() -> Column:
    """First reason an order is refused, null when it is sound."""
    doc = F.col("doc")
    total = member(doc, ".totals.total", "double")
    return F.coalesce(
        _first_falsy(V.DOC_ORDER_REQUIRED),
        _not_in("status", V.DOC_ORDER_STATUSES, "order status"),
        F.when(member(doc, ".items", "array<variant>").isNull(), F.lit("items must be a non-empty list")),
        F.when(F.coalesce(total, F.lit(-1.0)) < 0, F.lit("order total must be non-negative")),
    )


TOPIC_MEMBERS = sorted({*V.EVENT_REQUIRED, *V.DOC_ORDER_REQUIRED})


def topic_error(topic: Column) -> Column:
    """Reason a message is refused given the topic it came on, null when it is sound."""
    return (
        F.when(F.col("doc").isNull(), F.lit("invalid JSON"))
        .when(topic == "events", event_error())
        .when(topic == "orders", order_error())
        .otherwise(F.concat(F.lit("unexpected topic: "), topic))
    )


def refusal_envelope(topic: Column, value: Column, reason: Column, failed_at: Column) -> Column:
    """JSON envelope for a refused message."""
    return F.to_json(
        F.struct(
            topic.alias("original_topic"),
            value.alias("original_value"),
            reason.alias("reason"),
            failed_at.alias("failed_at"),
        )
    )
