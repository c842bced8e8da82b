"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .ladders import as_col, contains_any


def device_type(user_agent) -> Column:
    return contains_any(user_agent, V.DEVICE_FRAGMENTS, V.DEVICE_DEFAULT)


def browser(user_agent) -> Column:
    return contains_any(user_agent, V.BROWSER_FRAGMENTS, V.BROWSER_DEFAULT)


def full_name(first, last) -> Column:
    """First and last name with a space; null when either is missing."""
    return F.concat(as_col(first), F.lit(" "), as_col(last))


def ipv4_number(ip) -> Column:
    """Dotted IPv4 text to its 32-bit number; null for anything else."""
    ip = as_col(ip)
    parts = F.split(ip, r"\.")
    octets = [parts.getItem(i).try_cast("bigint") for i in range(4)]
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    well_formed = ip.rlike(r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$")
    return F.when(well_formed, number)


def alert_reason(score="ml_anomaly_score", any_rule="any_rule_triggered") -> Column:
    """All reasons a row was flagged, one after the other, outer blanks cut."""
    parts = [F.when(F.col(flag), F.lit(reason)).otherwise(F.lit("")) for flag, reason in V.ALERT_REASONS]
    model_only = (F.col(score) > V.ALERT_MODEL_SCORE) & ~F.col(any_rule)
    parts.append(F.when(model_only, F.lit(V.ALERT_MODEL_ONLY)).otherwise(F.lit("")))
    return F.trim(F.concat(*parts))
