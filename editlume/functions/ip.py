"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4 = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
_STRICT = r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"


def ipv4_to_long(ip: Column) -> Column:
    """The 32-bit value of a dotted address without leading zeros; NULL if it is none."""
    part = F.split(ip, r"\.")
    value = F.lit(0).cast("long")
    for k in range(4):
        value = value * 256 + F.try_to_number(F.get(part, F.lit(k)), F.lit("999")).cast("long")
    return F.when(ip.rlike(_STRICT), value)


def strip_octet_zeros(ip: Column) -> Column:
    """Three-digit octets without their leading zeros (000 -> 0, 010 -> 10, 001 -> 1); others unchanged."""
    return F.regexp_replace(F.regexp_replace(ip, "000", "0"), r"\b(?:00(?=\d\b)|0(?=[1-9]\d\b))", "")
