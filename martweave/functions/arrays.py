"""Array and nested-field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ladders import as_col


def add_to_set(array, element) -> Column:
    """Append unless present; a missing array starts empty."""
    element = as_col(element)
    array = as_col(array)
    return F.when(array.isNull(), F.array(element)).otherwise(
        F.when(F.array_contains(array, element), array).otherwise(F.array_append(array, element))
    )


def push(array, element) -> Column:
    element = as_col(element)
    array = as_col(array)
    return F.coalesce(F.array_append(array, element), F.array(element))


def pull(array, unwanted) -> Column:
    """Array without any element listed in `unwanted`; order and repeats of the rest stay."""
    unwanted = as_col(unwanted)
    return F.filter(as_col(array), lambda x: ~F.array_contains(unwanted, x))


def nth(array, index: int) -> Column:
    """Zero-based element, null outside the array."""
    return F.get(as_col(array), F.lit(index))


def first_n(array, count: int) -> Column:
    return F.slice(as_col(array), 1, count)


def contains(array, element) -> Column:
    return F.array_contains(as_col(array), as_col(element))


def missing_names(required, present) -> Column:
    """Names of `required` absent from the array `present`, sorted."""
    wanted = F.array(*[F.lit(name) for name in sorted(required)])
    return F.array_sort(F.array_except(wanted, as_col(present)))


def set_field(struct, field: str, value: Column) -> Column:
    return as_col(struct).withField(field, value)


def line_total(items) -> Column:
    """Sum of unit_price x quantity over an array of line items."""
    return F.aggregate(
        as_col(items),
        F.lit(0).cast("decimal(28,2)"),
        lambda acc, x: (acc + x["unit_price"].cast("decimal(18,2)") * x["quantity"]).cast("decimal(28,2)"),
    )
