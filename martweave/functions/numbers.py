"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ladders import as_col

# what a float literal in text may look like: no type suffix, single underscores between digits
_FLOAT_TEXT = (
    r"^[+-]?((\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?"
    r"|[nN][aA][nN])$"
)


def float_from_text(text) -> Column:
    """Text to double under the float-literal grammar above; null when it does not fit."""
    text = F.trim(as_col(text))
    return F.when(text.rlike(_FLOAT_TEXT), F.regexp_replace(text, "_", "").try_cast("double"))


def ratio(top, bottom) -> Column:
    """Quotient, null when the divisor is 0."""
    return F.try_divide(as_col(top), as_col(bottom))


def share_pct(part, whole, digits: int = 2) -> Column:
    return F.round(F.try_divide(as_col(part) * F.lit(100).cast("decimal(5,1)"), as_col(whole)), digits)


def ratio_or_zero(top, bottom) -> Column:
    """Quotient where the divisor is positive, else 0.0."""
    bottom = as_col(bottom)
    return F.when(bottom > 0, as_col(top) / bottom).otherwise(F.lit(0.0))


def clamp(value, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), as_col(value)))


def ceil_to(value, digits: int) -> Column:
    """Round up at the given number of decimals, exactly (decimal arithmetic)."""
    return F.ceil(as_col(value), F.lit(digits))


def page_count(total, size: int) -> Column:
    return F.floor((as_col(total) + F.lit(size - 1)) / F.lit(size)).cast("bigint")


def count_if(test: Column) -> Column:
    return F.count_if(test)


def sum_if(test: Column, value) -> Column:
    """Sum over rows passing the test; rows failing it add zero, so the sum is 0 and not null."""
    value = as_col(value)
    return F.sum(F.when(test, value).otherwise(F.lit(0)))


def currency_text(value, symbol: str = "$", scale: int = 0) -> Column:
    """Symbol followed by the amount.  The warehouse's unscaled numeric cast drops the
    cents before rounding, hence scale 0; pass 2 to keep them.  Null in, null out."""
    return F.concat(F.lit(symbol), F.round(as_col(value).cast(f"decimal(38,{scale})"), 2).cast("string"))
