"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ladders import as_col

# ISO 8601 extended form: date, optional clock, optional offset
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
_HOUR_ONLY = r"([T ]\d{2})$"


def days_between(later, earlier) -> Column:
    return F.datediff(as_col(later), as_col(earlier))


def days_before(day, count) -> Column:
    return F.date_sub(as_col(day), as_col(count))


def date_from_parts(year, month_name, day) -> Column:
    """Date from a year, an English month name and a day of month."""
    text = F.concat_ws("-", as_col(year).cast("string"), as_col(month_name), as_col(day).cast("string"))
    return F.to_date(text, "yyyy-MMMM-d")


def instant(text) -> Column:
    """ISO text to an instant (session zone UTC); a bad text raises, as a strict cast does."""
    return as_col(text).cast("timestamp")


def wall_clock(text) -> Column:
    """The clock reading written in ISO text, in its own offset; null when it is not ISO text."""
    text = as_col(text)
    clock = F.regexp_replace(F.translate(text, ",", "."), _OFFSET, "")
    # a bare date must keep its day part: only texts with a clock carry an offset
    clock = F.when(F.length(text) > 10, clock).otherwise(text)
    clock = F.regexp_replace(clock, _HOUR_ONLY, "$1:00")
    return F.when(text.rlike(ISO_PATTERN), clock.try_cast("timestamp"))


def is_iso_text(text) -> Column:
    return F.coalesce(wall_clock(text).isNotNull(), F.lit(False))


def weekday_monday0(moment) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(as_col(moment))


def iso_utc(moment) -> Column:
    """Instant as ISO text with the +00:00 offset; fraction only when there is one."""
    moment = as_col(moment)
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", F.lit("")).otherwise(fraction), F.lit("+00:00"))
