"""Network addresses as sortable keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAPPED = "00000000000000000000ffff"


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _octets_hex(text: Column) -> Column:
    """Eight hex digits of a dotted address, null if it is none."""
    sound = text.rlike(r"^(0|[1-9]\d{0,2})(\.(0|[1-9]\d{0,2})){3}$")

    def digits(numbers: Column) -> Column:
        return F.when(F.array_max(numbers) <= 255, F.lower(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), 2, "0")), "")))

    return _bound(F.transform(F.split(F.when(sound, text), r"\."), lambda x: x.cast("int")), digits)


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _dotted_end_as_groups(text: Column) -> Column:
    """The text with a dotted end written as two groups, null if that end is unsound."""
    head = F.regexp_replace(text, r"[0-9.]*\.[0-9.]*$", "")
    return F.when(F.instr(text, ".") == 0, text).otherwise(
        _bound(_octets_hex(F.substring(text, F.length(head) + 1, F.length(text))), lambda t: F.concat(head, F.substring(t, 1, 4), F.lit(":"), F.substring(t, 5, 4)))
    )


def _filled(sides: Column) -> Column:
    """All eight groups, those that `::` stands for as zeros; null if there are too many or too few."""
    nothing = F.array().cast("array<string>")
    split = F.struct(_groups(sides[0]).alias("left"), F.when(F.size(sides) == 2, _groups(F.get(sides, F.lit(1)))).otherwise(nothing).alias("right"))

    def joined(s: Column) -> Column:
        missing = 8 - F.size(s["left"]) - F.size(s["right"])
        zeros = F.when((F.size(sides) == 2) & (missing >= 1), F.array_repeat(F.lit("0"), missing)).when(
            (F.size(sides) == 1) & (missing == 0), nothing
        )
        return F.concat(s["left"], zeros, s["right"])

    return _bound(split, joined)


def _groups_hex(groups: Column) -> Column:
    sound = F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    return F.when(sound, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))


def address_key(address: str | Column) -> Column:
    """16 bytes that sort as the address: version 6 as it is, version 4 as `::ffff:a.b.c.d`; null if it is no address."""

    def key(text: Column) -> Column:
        six = _bound(_bound(F.split(_dotted_end_as_groups(text), "::"), _filled), _groups_hex)
        return F.unhex(F.when(F.instr(text, ":") > 0, six).otherwise(F.concat(F.lit(_MAPPED), _octets_hex(text))))

    return _bound(F.lower(F.trim(F.col(address) if isinstance(address, str) else address)), key)
